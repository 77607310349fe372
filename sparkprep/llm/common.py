"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkprep.session import drop_scratch, scratch_path, written

# Fixed value: the white space that separates words everywhere in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it was running, not the
    steps before. Joins of stored tables are plain shuffles, which Spark can
    split where one key is hot.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables in the shared folder by name; a new one of a name replaces the old, which is deleted."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def put(self, name: str, df: DataFrame, packed: bool = False) -> DataFrame:
        """Write a table and read it back; ``df`` may read the old table of the name.

        A ``packed`` one is shuffled once more into files of even, full size: for narrow tables
        that many small jobs read, where each file of a few rows would be a task in all of them.
        """
        table, path = written(df.hint("rebalance") if packed else df, name)
        self.drop(name)
        self.paths[name] = path
        return table

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.paths.pop(name, None)
            if path:
                drop_scratch(self.spark, path)

    def drop_but(self, *names: str) -> None:
        """Delete all tables but these."""
        self.drop(*[name for name in self.paths if name not in names])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value to a name, so that a lambda inside ``body`` does not compute it again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(text, SPACE), "")


def char_count(text: Column, chars: str) -> Column:
    """How many characters of a text are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))
