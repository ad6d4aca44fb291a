"""Readers of the export documents, and writers and readers of the mart tables."""
