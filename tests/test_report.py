"""The report shows every row of its tables."""

from pyspark.sql import functions as F

from wildtally.plans import report


def test_report_shows_all_rows(spark):
    rows = spark.range(250).select(F.format_string("c%03d", "id").alias("species"), F.col("id").alias("n"))
    assert report.html_table(rows).count("<tr>") == 251
    assert report.heat_rows(rows).count("<tr>") == 250
