"""Operators over voxel tables (DataFrame -> DataFrame)."""
