"""Part of quarryframe."""
