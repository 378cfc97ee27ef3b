"""JDBC reads of the two source databases: watermark pushed down, parallel only with all bounds given."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Driver classes, literal formats and default parallelism per database.
DIALECTS = {
    "oracle": {
        "driver": "oracle.jdbc.driver.OracleDriver",
        "literal": "TO_TIMESTAMP('{:%Y-%m-%dT%H:%M:%S}', 'YYYY-MM-DD\"T\"HH24:MI:SS')",
        "partitions": 4,
    },
    "sqlserver": {
        "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        "literal": "'{:%Y-%m-%d %H:%M:%S}'",
        "partitions": 8,
    },
}
FETCH_SIZE = 10000


@dataclass(frozen=True)
class JdbcSource:
    dialect: str
    url: str
    user: str
    password: str

    def options(
        self,
        table: str,
        partition_column: str | None = None,
        bounds: tuple[object, object] | None = None,
        num_partitions: int | None = None,
        watermark_column: str | None = None,
        watermark: datetime | None = None,
    ) -> dict[str, str]:
        """Reader options. Parallel reads need the column and both bounds, as Spark does."""
        if self.dialect not in DIALECTS:
            raise ValueError(f"unknown dialect {self.dialect!r}")
        if (partition_column is None) != (bounds is None):
            raise ValueError("a parallel read needs both partition_column and bounds")
        if (watermark_column is None) != (watermark is None):
            raise ValueError("an incremental read needs both watermark_column and watermark")
        spec = DIALECTS[self.dialect]
        query = f"SELECT * FROM {table}"
        if watermark is not None:
            query += f" WHERE {watermark_column} > " + spec["literal"].format(watermark)
        out = {
            "url": self.url,
            "dbtable": f"({query}) src",
            "user": self.user,
            "password": self.password,
            "driver": spec["driver"],
            "fetchsize": str(FETCH_SIZE),
        }
        if partition_column is not None:
            out |= {
                "partitionColumn": partition_column,
                "lowerBound": str(bounds[0]),
                "upperBound": str(bounds[1]),
                "numPartitions": str(num_partitions or spec["partitions"]),
            }
        return out

    def read(self, spark: SparkSession, table: str, schema: T.StructType | None = None, **more) -> DataFrame:
        df = spark.read.format("jdbc").options(**self.options(table, **more)).load()
        if schema is None:
            return df
        by_lower = {c.lower(): c for c in df.columns}
        return df.select(*[F.col(by_lower[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema])
