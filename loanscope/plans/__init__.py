"""User-facing views, the materialising warehouse and batch jobs."""
