"""Query bindings: operators applied to the fixture views, one per SURVEY key."""
