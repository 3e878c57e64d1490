"""Sessions: UTC, a default catalog on Glue or a REST server where one is set, and settings that suit the engine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from tidewell.settings import Settings

#: What every session has: AQE (coalescing, skew joins) is Spark's default and stays.
COMMON = {"spark.sql.session.timeZone": "UTC"}
STREAMING = {"spark.scheduler.mode": "FAIR", "spark.sql.caseSensitive": "true"}


def catalog_options(settings: Settings) -> dict[str, str]:
    """Options of the table catalog; none for a local one."""
    kind = settings.storage.get("catalog_type", "local")
    if kind == "local":
        return {}
    name = settings.catalog
    base = f"spark.sql.catalog.{name}"
    shared = {
        "spark.sql.defaultCatalog": name,
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        base: "org.apache.iceberg.spark.SparkCatalog",
    }
    if kind == "polaris":
        p = settings.polaris
        if not p:
            raise ValueError("a REST catalog needs POLARIS__ settings")
        own = {
            "type": "rest", "warehouse": name, "uri": p["uri"], "oauth2-server-uri": p["oauth2_server_uri"], "credential": p["credential"], "scope": p["scope"],
            "header.Polaris-Realm": p["realm"], "header.X-Iceberg-Access-Delegation": "vended-credentials", "token-refresh-enabled": "true",
        }
        return shared | {f"{base}.{k}": v for k, v in own.items()}
    own = {
        "catalog-impl": "org.apache.iceberg.aws.glue.GlueCatalog", "io-impl": "org.apache.iceberg.aws.s3.S3FileIO", "warehouse": settings.warehouse,
        "s3.path-style-access": "true",
    }
    provider = {"spark.hadoop.fs.s3a.aws.credentials.provider": "software.amazon.awssdk.auth.credentials.DefaultCredentialsProvider"}
    return shared | {f"{base}.{k}": v for k, v in own.items()} | provider


def create_session(app: str, settings: Settings | None = None, extra: Mapping[str, str] | None = None, remote: str | None = None) -> SparkSession:
    """A session; ``extra`` comes last.  ``remote``: a Spark Connect server's address."""
    options = COMMON | (catalog_options(settings) if settings else {}) | dict(extra or {})
    builder = SparkSession.builder.appName(app)
    builder = builder.remote(remote) if remote else builder
    return builder.config(map=options).getOrCreate()


def logger(spark: SparkSession, name: str = "tidewell"):
    """The JVM's logger, so that messages stand in the driver's own log."""
    return spark.sparkContext._jvm.org.apache.log4j.LogManager.getLogger(name)
