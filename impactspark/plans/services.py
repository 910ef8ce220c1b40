"""PIPE-2: logged services (indicator 7) -- three service branches, one union,
one join to the eligible-learner set, date-derived fields computed once.

Filters sit on each branch before the union so they reach the scans; the
shared person logic is joined once, after the union (one shuffle join
instead of three).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fx
from ..operators import union_all

SERVICE_COLUMNS = ("learner_id", "date_service_accessed", "service_used", "service_name")


def eligible_learners(learners: DataFrame, apps_to_use: DataFrame, cities: DataFrame,
                      provinces: DataFrame, area_types: DataFrame) -> DataFrame:
    """Person logic shared by every branch (self-report eligibility FLT-7/8)."""
    ll = learners.filter(fx.self_reported_citizen("is_south_african_citizen", "nationality")
                         & fx.not_employed_not_test("is_currently_employed", "test_account"))
    la = apps_to_use.select(F.col("learner_id").alias("__l"), F.col("id").alias("application_id"),
                            F.coalesce("registration_date", "date_updated").alias("application_date"))
    j = ll.join(la, ll["id"] == F.col("__l"), "left")
    area = area_types.select(F.col("id").alias("__a_id"), F.col("name").alias("residential_area_type"))
    city = cities.select(F.col("id").alias("__c_id"), F.col("name").alias("nearest_metro"))
    prov = provinces.select(F.col("id").alias("__p_id"), F.col("name").alias("province_name"))
    j = (j.join(area, F.col("residential_area_type_id") == F.col("__a_id"), "left")
          .join(city, F.col("nearest_city") == F.col("__c_id"), "left")
          .join(prov, F.nullif(F.trim(F.col("province")), F.lit("")).try_cast("int") == F.col("__p_id"), "left"))
    return j.select(
        F.col("id").alias("learner_id"), "application_id",
        F.coalesce("umuzi_email", "email").alias("umuzi_email"),
        "first_name", "last_name", "cellphone_number", "id_number", "gender", "date_of_birth",
        "race", "residential_area_type", "has_disability_or_differently_abled",
        "application_date", "nearest_metro", F.col("province_name").alias("province"))


def bootcamp_services(rsvps: DataFrame, cutoff: str) -> DataFrame:
    return (rsvps.filter((F.col("rsvp_date") >= F.lit(cutoff).cast("timestamp_ntz"))
                         & fx.outcome_counts("bootcamp_result_id", "rejection_reason_id"))
                 .select("learner_id",
                         F.col("start_date").cast("timestamp_ntz").alias("date_service_accessed"),
                         F.lit("Bootcamp").alias("service_used"),
                         F.concat(F.col("bootcamp_name"), F.lit("-bootcamp")).alias("service_name")))


def programme_services(enrolments: DataFrame, cutoff: str, vendor: str) -> DataFrame:
    """Programme enrolments; the vendor's programmes are counted by their own branch."""
    return (enrolments.filter(fx.on_or_after_or_null("start_date", cutoff)
                              & fx.not_ilike("name", f"%{vendor}%"))
                      .select("learner_id",
                              F.to_date("start_date").cast("timestamp_ntz").alias("date_service_accessed"),
                              F.lit("programme enrollment").alias("service_used"),
                              F.col("name").alias("service_name")))


def course_completions(certs: DataFrame, courses: DataFrame, pathway_courses: DataFrame) -> DataFrame:
    """AGG-5: per learner and course name the first certificate and the sorted list of pathways.

    Certificates reduce to one row per (learner, course id) map-side before
    anything is joined, and the course -> pathway fan-out collapses to one
    list per course on the dimension's side, so no row is multiplied.
    """
    first = certs.groupBy("learner_id", "course_id").agg(F.min("certificate_uploaded_at").alias("first_at"))
    lists = pathway_courses.groupBy(F.col("course_id").alias("__c")).agg(F.collect_set("pathway").alias("paths"))
    info = courses.select(F.col("id").alias("__c"), F.col("name").alias("course_name")).join(lists, "__c")
    j = first.join(info, first["course_id"] == F.col("__c"))
    return j.groupBy("learner_id", "course_name").agg(
        F.min("first_at").alias("first_at"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("paths")))), ", ").alias("pathways"))


def certificate_services(certs: DataFrame, courses: DataFrame, pathway_courses: DataFrame,
                         cutoff: str) -> DataFrame:
    """Course certificates since the cutoff as services."""
    recent = certs.filter(F.col("certificate_uploaded_at") >= F.lit(cutoff).cast("timestamp_ntz"))
    return course_completions(recent, courses, pathway_courses).select(
        "learner_id", F.col("first_at").alias("date_service_accessed"),
        F.col("course_name").alias("service_used"), F.col("pathways").alias("service_name"))


def logged_services(eligible: DataFrame, branches) -> DataFrame:
    """Union of the service branches joined to the eligible learners."""
    s = union_all([b.select(*SERVICE_COLUMNS) for b in branches])
    j = s.join(eligible, "learner_id")
    d, dob = F.col("date_service_accessed"), F.col("date_of_birth")
    return j.select(
        "learner_id", "application_id", "date_service_accessed", "umuzi_email",
        "first_name", "last_name", "cellphone_number", "id_number", "gender", "date_of_birth",
        fx.age_calendar(d, dob).alias("age_service_accessed"),
        "race", "residential_area_type", "has_disability_or_differently_abled",
        "application_date",
        fx.month_year_padded(d).alias("month_of_service_accessed"),
        fx.band_calendar(d, dob).alias("age_range"),
        "nearest_metro", "province", "service_used", "service_name")
