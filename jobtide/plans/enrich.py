"""Raw postings to cleaned postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide import fixed_values as fixed
from jobtide.functions import extract, geo, periods, tags
from jobtide.functions.lexicon import Lexicon
from jobtide.functions.text import nonempty, strip
from jobtide.operators.conform import select_existing
from jobtide.operators.rows import keep_first


def enrich_postings(
    raw: DataFrame,
    order: Sequence[str] = ("scraped_at", "url"),
    lexicon: Lexicon = tags.SKILLS,
    gazetteer: geo.Gazetteer | None = None,
    date_formats: Sequence[str] = periods.DATE_FORMATS,
) -> DataFrame:
    """De-duplicated postings with skills, salary, seniority, place, workload and quarter.

    One shuffle (the de-duplication); everything after it is a projection.
    """
    # The digest of the whole row settles what the order leaves tied, whatever the partitioning.
    tied = raw.withColumn("_digest", F.xxhash64(*sorted(raw.columns)))
    df = keep_first(tied, ["job_id"], [*order, "_digest"]).drop("_digest")
    df = df.withColumnsRenamed({"search_term": "role", "description_clean": "description"})
    df = df.withColumns({"location_raw": nonempty("location_raw"), "role": strip(F.lower("role"))})
    df = df.withColumns(
        {
            "posted_date": periods.parse_date("posted_date", date_formats),
            "skills": tags.dictionary_tags("title", "description", "role", lexicon=lexicon),
            "_salary": extract.salary_range("description"),
            "seniority": extract.seniority("title", "description"),
            "canton": geo.canton("location_raw", gazetteer),
            "city": geo.city("location_raw", gazetteer),
            "_workload": extract.workload_bounds("workload_raw"),
        }
    )
    df = df.withColumns(
        {
            "quarter": periods.quarter_label("posted_date"),
            "macro_quarter": periods.quarter_label("posted_date"),
            "skill_count": F.size("skills"),
            "salary_min": F.col("_salary.min"),
            "salary_max": F.col("_salary.max"),
            "salary_available": extract.disclosed("_salary"),
            "region": geo.region("canton", gazetteer),
            "workload_min": F.col("_workload.min"),
            "workload_max": F.col("_workload.max"),
        }
    )
    return select_existing(df, fixed.CLEAN_COLUMNS)
