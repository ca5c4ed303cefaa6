"""Tables stored by calendar month: dates reach the scan as partitions, and single months can be written again.

The months there are follow from the folder names, so the newest month, its quarter, or the years with sales cost one listing and
no scan. Writing replaces the months it holds and leaves the others as they are.
"""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import functions as F

from . import folders

MONTH = "mes"


def quarter_start(day):
    return date(day.year, day.month - (day.month - 1) % 3, 1)


def months_later(day, months):
    """The first of the month so many months after that of ``day``."""
    number = day.year * 12 + day.month - 1 + months
    return date(number // 12, number % 12 + 1, 1)


def months_of_quarters(quarters):
    """First days of all months in the given (year, quarter) pairs."""
    return [date(year, 3 * quarter - 2 + m, 1) for year, quarter in sorted(quarters) for m in range(3)]


@dataclass(frozen=True)
class MonthlyTable:
    path: str
    # The column whose month a row belongs to.
    at: str

    def write(self, df, months=None, shuffle=True):
        """Replace the months of ``df``, or exactly ``months``: those of which it has no row become empty.

        Rows are brought together by month, in files of an even size. Without ``shuffle`` each partition of ``df`` writes a file
        for each of its months, so that rows just joined need not be shuffled again: for frames of few, large partitions.
        """
        spark = df.sparkSession
        rows = df.withColumn(MONTH, F.trunc(self.at, "month"))
        gone = set()
        if months is not None:
            rows = rows.filter(F.col(MONTH).isin(list(months)))
            gone = set(months) - {r[0] for r in rows.select(MONTH).distinct().collect()}
        rows = rows.hint("rebalance", MONTH) if shuffle else rows
        writer = rows.write.mode("overwrite").options(partitionOverwriteMode="dynamic", compression="zstd")
        writer.partitionBy(MONTH).parquet(self.path)
        for month in gone:
            folders.delete(spark, f"{self.path}/{MONTH}={month.isoformat()}")

    def months(self, spark):
        """The months that have rows, oldest first; rows without a date belong to none."""
        names = [n.partition("=")[2] for n in folders.children(spark, self.path) if n.startswith(f"{MONTH}=")]
        return sorted(date.fromisoformat(n) for n in names if n[:1].isdigit())

    def newest(self, spark):
        months = self.months(spark)
        return months[-1] if months else None

    def read(self, spark, since=None, before=None, months=None):
        """Rows of the months from ``since`` on, before another one, or of the given ones; only their files are opened."""
        frame = spark.read.parquet(self.path)
        for keep in ([] if since is None else [F.col(MONTH) >= since], [] if before is None else [F.col(MONTH) < before],
                     [] if months is None else [F.col(MONTH).isin(list(months))]):
            for condition in keep:
                frame = frame.filter(condition)
        return frame.drop(MONTH)
