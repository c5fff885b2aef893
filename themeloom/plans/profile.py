"""The full profile report of a document table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.operators import profile as P
from themeloom.sources.documents import write_table


def profile_report(df: DataFrame, stopwords=(), path: str | None = None) -> DataFrame:
    """One row: basic counts, missing values, text statistics of the target column, top words.

    The target is ``Abstract``, else ``Title``; a table with neither has null text statistics and no
    top words. With ``path`` the row is written as JSON.
    """
    basic = P.record_count(df)
    missing = P.null_counts(df).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("column", "missing")))).alias("missing_values")
    )
    copies = P.duplicate_count(df)
    target = P.profile_target(df)
    report = basic.select(
        "total_records", "columns",
        missing.scalar().alias("missing_values"), copies.scalar().alias("duplicates"),
    )
    if target is None:
        report = report.withColumns({
            "text_column": F.lit(None).cast("string"),
            "text_statistics": F.lit(None).cast(
                "struct<mean_word_count:double,max_word_count:bigint,min_word_count:bigint,mean_char_count:double>"
            ),
            "top_words": F.array().cast("array<struct<term:string,n:bigint>>"),
        })
    else:
        text = df.select(P.profile_text(df).alias("doc"))
        words = P.top_words(text, "doc", stopwords).agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "term"))),
                lambda w: F.struct(w["term"].alias("term"), (-w["m"]).alias("n")),
            ).alias("top_words")
        )
        stats = P.text_statistics(df, target).select(F.struct("*"))
        report = report.withColumns({
            "text_column": F.lit(target), "text_statistics": stats.scalar(), "top_words": words.scalar(),
        })
    if path is not None:
        write_table(report, path, "json")
    return report
