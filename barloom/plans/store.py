"""Where the tables of one price history live.

Folders are looked up and dropped through the JVM's file system, which Spark Connect does not offer.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas as S
from ..session import no_rows
from ..sinks import tables as sink


def _plus(schema, **fields):
    return T.StructType([*schema.fields, *[T.StructField(n, t) for n, t in fields.items()]])


_DATE, _INT, _TEXT, _BOOL = T.DateType(), T.IntegerType(), T.StringType(), T.BooleanType()
_REJECTED = _plus(S.BARS, seq=S.SEQ, batch=_TEXT)

SCHEMAS = {
    "bars": _plus(S.BARS, seq=S.SEQ, year=_INT),
    "bars_mod": _plus(S.BARS_MOD, year=_INT),
    "bars_skipped": _REJECTED,
    "bars_duplicates": _REJECTED,
    "bars_late": _REJECTED,
    "bars_undated": _REJECTED,
    "bars_malformed": T.StructType([S.MALFORMED, T.StructField("seq", S.SEQ), T.StructField("batch", _TEXT)]),
    "bars_replace": _plus(S.BARS, seq=S.SEQ),
    "replacements_refused": _plus(S.BARS, pair=_TEXT, seq=S.SEQ, reason=_TEXT, batch=_TEXT),
    "bars_unverified": _plus(S.BARS, seq=S.SEQ, batch=_TEXT),
    "modified_losers": _plus(S.BARS, batch=_TEXT),
    "multipliers": _plus(S.MULTIPLIERS, seq=S.SEQ, cum_multiplier=T.DoubleType()),
    "multipliers_skipped": S.MULTIPLIERS,
    "symbol_range": S.RANGES,
    "range_anomalies": T.StructType(
        [
            *S.RANGES.fields[:2],
            *[T.StructField(c, _DATE) for c in ("min_dt", "max_dt", "start_dt", "end_dt")],
            *[T.StructField(c, _BOOL) for c in ("starts_early", "ends_inside")],
            T.StructField("batch", _TEXT),
        ]
    ),
    "index_changes": _plus(S.SNAPSHOTS, change_type=_TEXT, seq=S.SEQ),
    "snapshots": S.SNAPSHOTS,
}


@dataclass(frozen=True)
class PriceStore:
    spark: SparkSession
    root: str

    def path(self, table) -> str:
        return f"{self.root}/{table}"

    def read(self, table) -> DataFrame:
        """The table, or no rows while it has not been written."""
        if not self.exists(self.path(table)):
            return no_rows(self.spark, SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(self.path(table))

    def stage_once(self, df: DataFrame, label, batch, partition_by=()) -> DataFrame:
        """Write a step's result under the run's name; a run that is started again after a failure reads it.

        Later steps then see the same rows even if the tables have changed in between. A run that
        ends well drops what it staged, so the next one of the name reads its inputs anew.
        """
        path = self.path(f"_staged/{batch}/{label}")
        if not self.is_staged(label, batch):
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def is_staged(self, label, batch) -> bool:
        return self.exists(self.path(f"_staged/{batch}/{label}/_SUCCESS"))

    def staged(self, label, batch, schema=None) -> DataFrame:
        """What a run has staged before; a copy that may have no file needs its `schema`."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(f"_staged/{batch}/{label}"))

    def stage_for(self, table, batch):
        """`stage` of the sinks that replace rows of a table in a run."""
        return lambda df, label: self.stage_once(df, f"{label}-{table}", batch)

    def first_try(self, step, batch) -> bool:
        """Whether a run comes to this step for the first time; from then on it does not."""
        path = self.path(f"_staged/{batch}/tried-{step}")
        if self.exists(f"{path}/_SUCCESS"):
            return False
        self.spark.range(0).write.mode("overwrite").parquet(path)
        return True

    def replace(self, df: DataFrame, table, batch) -> None:
        sink.replace_table(df, self.path(table), self.stage_for(table, batch))

    def drop_staged(self, batch, label=None) -> None:
        """Drop what a run has staged, or one copy that it has no more use for."""
        location, system = self._location(self.path(f"_staged/{batch}" if label is None else f"_staged/{batch}/{label}"))
        system.delete(location, True)

    def _location(self, path):
        location = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return location, location.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path) -> bool:
        location, system = self._location(path)
        return system.exists(location)
