"""Readers and writers."""

from pyspark.sql import SparkSession


def register(spark: SparkSession) -> None:
    """Make the ``shp`` and ``las`` formats known to a session."""
    from skytrace.sources.las import LasDataSource
    from skytrace.sources.shapefile import ShapefileDataSource

    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS")
    for source in (ShapefileDataSource, LasDataSource):
        # Classes made here travel to the workers with their value of the default file system.
        own = type(source.__name__, (source,), {"default_fs": default})
        spark.dataSource.register(own)
