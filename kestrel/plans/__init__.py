"""Driver query catalogue (``catalog``), its SQL oracles (``oracle``) and end-to-end flows (``flows``)."""
