"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: what separates words, and the letters that are lower-cased ---
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def named(name: str) -> Column:
    """A column by its exact name, dots and backquotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, label: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {name.lower() for name in df.columns}
    while label.lower() in taken:
        label += "_"
    return label


def whole(text: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, every other letter as it is.

    ``lower`` does that for pure ASCII, many times faster than ``translate``.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def words(text: Column) -> Column:
    """The words of a text that is not null."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once per row.

    A column that is named and then used several times may be put back into every use when a
    filter or a projection is pushed down; the argument of a function is not.
    """
    return F.get(F.transform(F.array(value), use), 0)


class Recent(dict):
    """Values of a function, remembered for the keys asked for last.

    Holds at most twice ``size`` short keys: a full generation becomes the older one, from
    which keys come back when they are asked for again.
    """

    def __init__(self, make, size: int):
        self.make, self.size, self.older = make, size, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
