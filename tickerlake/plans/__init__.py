"""The model graph: warehouse, feature marts, template marts, reports, ML."""
