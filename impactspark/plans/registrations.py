"""PIPE-0 / PIPE-1: applications to use, registrations (indicator 5), enrichment dimension.

Plan shape: one window-dedup of applications (partial top-1 before the
shuffle), one shuffle join to learners, and left joins to three lookups
that are a few dozen rows each (AQE broadcasts them from measured size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from ..operators import latest_preferred

PREFERRED_STATUS = "Accepted"


def applications_to_use(applications: DataFrame, statuses: DataFrame,
                        status_col: str = "staus", preferred: str = PREFERRED_STATUS) -> DataFrame:
    """DED-1: per learner, the preferred-status application, else the most recent.

    Inner join to the status table (unresolved ids drop out), then
    ``DISTINCT ON (learner_id)`` ordered by (status = preferred) DESC,
    date_created DESC -- both with PostgreSQL's NULLS FIRST -- and id DESC
    as the tie-break.  The status table is a short vocabulary, so it is
    broadcast.
    """
    st = F.broadcast(statuses.select(F.col("id").alias("__sid"), F.col(status_col).alias("__st")))
    j = applications.join(st, applications["application_status_id"] == st["__sid"])
    pref = F.col("__st") == F.lit(preferred)
    out = latest_preferred(j, "learner_id", [pref.desc_nulls_first(),
                                             F.col("date_created").desc_nulls_first(),
                                             F.col("id").desc()])
    return out.drop("__sid", "__st")


def legacy_applications_to_use(applications: DataFrame, statuses: DataFrame,
                               status_col: str = "staus", preferred: str = PREFERRED_STATUS) -> DataFrame:
    """JN-10: the older form -- latest preferred application, plus the latest
    application with any status for learners that have no preferred one."""
    st = F.broadcast(statuses.select(F.col("id").alias("__sid"), F.col(status_col).alias("__st")))
    order = [F.col("date_created").desc_nulls_first(), F.col("id").desc()]
    acc = latest_preferred(
        applications.join(st, applications["application_status_id"] == st["__sid"])
                    .filter(F.col("__st") == preferred).drop("__sid", "__st"),
        "learner_id", order)
    latest = latest_preferred(applications.filter(F.col("application_status_id").isNotNull()),
                              "learner_id", order)
    rest = latest.join(acc.select(F.col("learner_id").alias("__l")),
                       latest["learner_id"] == F.col("__l"), "left_anti")
    return acc.unionByName(rest)


def _lookup(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(F.col("id").alias(prefix + "id"), F.col("name").alias(prefix + "name"))


def registrations(learners: DataFrame, apps_to_use: DataFrame, cities: DataFrame,
                  provinces: DataFrame, area_types: DataFrame, cutoff: str) -> DataFrame:
    """PIPE-1: eligible registrations on or after ``cutoff``.

    Anchor date: COALESCE(registration_date, date_created) (T12).  Eligibility:
    FLT-6 national-id rule, not employed, not a test account (NULL drops).
    """
    la = apps_to_use.withColumn("application_date",
                                F.coalesce("registration_date", "date_created"))
    la = la.filter(F.col("application_date") >= F.lit(cutoff).cast("timestamp_ntz"))
    ll = learners.filter(
        fx.national_id_eligible("id_number", "is_south_african_citizen", "nationality")
        & fx.not_employed_not_test("is_currently_employed", "test_account"))
    j = la.select(F.col("id").alias("application_id"), F.col("learner_id"), "application_date") \
          .join(ll, F.col("learner_id") == ll["id"])
    area, city, prov = _lookup(area_types, "__a_"), _lookup(cities, "__c_"), _lookup(provinces, "__p_")
    j = (j.join(area, F.col("residential_area_type_id") == F.col("__a_id"), "left")
          .join(city, F.col("nearest_city").cast("int") == F.col("__c_id"), "left")
          .join(prov, F.trim(F.col("province")).try_cast("int") == F.col("__p_id"), "left"))
    d, dob = F.col("application_date"), F.col("date_of_birth")
    return j.select(
        F.col("id").alias("learner_id"), "application_id", "application_date",
        fx.month_year_padded(d).alias("month_of_registration"),
        "email", "first_name", "last_name", "cellphone_number", "id_number", "gender",
        "date_of_birth",
        fx.age_calendar(d, dob).alias("age_at_application"),
        "has_disability_or_differently_abled",
        fx.band_calendar(d, dob).alias("age_range"),
        F.col("__c_name").alias("nearest_metro"),
        F.col("__p_name").alias("province"),
        F.col("__a_name").alias("residential_area_type"),
        "race",
    )


def enrichment_dimension(learners: DataFrame, apps_to_use: DataFrame, cities: DataFrame,
                         provinces: DataFrame, area_types: DataFrame) -> DataFrame:
    """PIPE-0: one row per eligible learner (self-report rule FLT-7/8) with the
    application anchored on COALESCE(registration_date, date_updated)."""
    ll = learners.filter(fx.self_reported_citizen("is_south_african_citizen", "nationality")
                         & fx.not_employed_not_test("is_currently_employed", "test_account"))
    la = apps_to_use.select(F.col("learner_id").alias("__l"), F.col("id").alias("application_id"),
                            F.coalesce("registration_date", "date_updated").alias("application_date"))
    j = ll.join(la, ll["id"] == F.col("__l"), "left")
    area, city, prov = _lookup(area_types, "__a_"), _lookup(cities, "__c_"), _lookup(provinces, "__p_")
    j = (j.join(area, F.col("residential_area_type_id") == F.col("__a_id"), "left")
          .join(city, F.col("nearest_city").cast("int") == F.col("__c_id"), "left")
          .join(prov, F.trim(F.col("province")).try_cast("int") == F.col("__p_id"), "left"))
    return j.select(
        F.col("id").alias("learner_id"), "application_id", "application_date",
        fx.month_year_padded("application_date").alias("month_of_registration"),
        "email", F.coalesce("umuzi_email", "email").alias("umuzi_email"),
        "first_name", "last_name", "cellphone_number", "id_number", "race", "gender",
        "date_of_birth", "has_disability_or_differently_abled",
        F.col("__c_name").alias("nearest_metro"), F.col("__p_name").alias("province"),
        F.col("__a_name").alias("residential_area_type"),
    )
