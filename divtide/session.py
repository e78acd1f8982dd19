"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every job here is planned for. Partition counts are left to the cluster: AQE merges
# small shuffle partitions, so `spark.sql.shuffle.partitions` may be set high (input bytes / 200 MB).
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", app: str = "divtide", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="divtide-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A path below the scratch root that nothing has used before."""
    return f"{scratch_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A relation that Spark knows has no rows, so that joins and unions with it are planned away."""
    return spark.range(1).where("false").select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def kept_once(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to scratch and read back, for what is read several times."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
