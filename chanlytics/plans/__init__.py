"""The data model (staging, marts) and the reports over it."""
