"""From resumes and market demand to the report that is shown for each resume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignal.functions import rules
from jobsignal.operators import gap
from jobsignal.operators.market import top_n


def compare(resumes: DataFrame, market: DataFrame, n: int | None = gap.TOP_N) -> DataFrame:
    """Gap report of every resume against the top of the market."""
    return gap.analyze(resumes, market, n)


def gap_bundle(resumes: DataFrame, market: DataFrame, served: int = gap.SERVED_MARKET,
               n: int | None = gap.TOP_N, path: int = gap.LEARNING_PATH) -> DataFrame:
    """Score, counts, lists, learning path and assessment per resume.

    The score takes all of the ``served`` top skills, the report its first ``n``; ``path`` is the
    length of the learning path.
    """
    top = top_n(market, served)
    report = gap.analyze(resumes, top, n)
    report = gap.with_match_rate(gap.with_learning_path(report, path), top, served)
    return report.select(
        *resumes.columns,
        "skill_score",
        F.col("matching_count").alias("match_count"),
        F.col("missing_count").alias("gap_count"),
        "resume_skill_count",
        "matching_skills",
        "missing_skills",
        F.col("learning_path").alias("recommendations"),
        "overall_assessment",
    )


def resume_report(analyzed: DataFrame, market: DataFrame, served: int = gap.SERVED_MARKET,
                  n: int | None = gap.TOP_N) -> DataFrame:
    """Resume analysis and, where there is a market, its gap analysis.

    Without market data ``gap_analysis`` is null and ``message`` says so.
    """
    report = gap.analyze(analyzed, top_n(market, served), n)
    fields = [c for c in report.columns if c not in analyzed.columns]
    known = F.col("market_total_skills") > 0
    return report.select(
        *analyzed.columns,
        F.when(known, F.struct(*fields)).alias("gap_analysis"),
        F.when(~known, F.lit(rules.NO_MARKET)).alias("message"),
    )
