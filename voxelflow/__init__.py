"""voxelflow: label and affinity volumes as sparse voxel tables on Spark.

Every operator is a function from DataFrame(s) to DataFrame built from joins,
aggregations, windows and iterative contraction, so that Catalyst and adaptive
query execution plan and distribute the work.
"""

__version__ = "0.1.0"
