"""Written stages in the folder that all executors share, and this package on the executors."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. A folder of this machine only under a local master,
    where driver and executors are one process; on a cluster its files would be on the executor that wrote them."""
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
        if made.isDefined():
            return made.get().rstrip("/")
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tracksieve-"))
        set_to = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return set_to.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read back: lineage ends here, executors can be lost."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def keeping(df: DataFrame, *stages: DataFrame) -> DataFrame:
    """df, which reads these stages: discard(df), once df is written itself, deletes them."""
    df._reads = stages
    return df


def discard(*stages: DataFrame) -> None:
    """Deletes stages that written() made, once what was computed from them is written too."""
    for df in stages:
        discard(*getattr(df, "_reads", ()))
        path = getattr(df, "_stage_path", None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Has the driver collect its garbage: shuffle files of plans that nobody holds any more go from the executors'
    disks, which otherwise happens whenever the driver's heap next fills. Then the executors, a task a core: each gives
    back what its heap had grown by, and the direct buffers that it has dropped. For after a stage, not within loops."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so that workers can import it anywhere."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="tracksieve-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
