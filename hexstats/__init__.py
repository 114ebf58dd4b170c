"""Batch analytics over indicator values on a multi-resolution hexagonal grid."""
