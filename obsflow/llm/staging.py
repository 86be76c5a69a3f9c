"""Intermediate results that survive a lost executor, in the folder that the cluster names."""

from __future__ import annotations

import gc

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from obsflow.session import shared_folder, work_folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """Written once as Parquet to the shared folder and read back, so columns can be pruned."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Lineage cut by a reliable checkpoint; for the narrow tables of iterative steps."""
    _ensure_checkpoints(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffles and checkpoints of finished rounds, and the driver's JVM give back what it has freed.

    It removes them only once the driver's garbage is collected, which may not happen during a long loop of
    small jobs; their files and the driver's heap would grow with the number of rounds. For long steps, not for short ones: when much time goes into
    full collections, the JVM widens its heap.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim(spark)


def trim(spark: SparkSession) -> bool:
    """Gives the system what the driver's JVM has freed outside its heap; False if this JVM has no command for it.

    Compilers, shuffles' threads and compression allocate there, and the allocator keeps it, so that a driver that plans many jobs grows by some hundred MB.
    """
    jvm, new_array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    # The server's class is internal to the JVM, so its method is taken from the interface.
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    given = new_array(jvm.java.lang.Object, 4)
    given[0], given[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), given)
    except Py4JJavaError:
        return False
    return True


def _ensure_checkpoints(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
