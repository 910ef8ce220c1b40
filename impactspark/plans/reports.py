"""Report-shaped builders shared by the earnings tables (PIPE-9..13).

All pivots take their value lists up front (the twelve fiscal months, and
for the ranked pivot the opportunity numbers), so each is one two-phase
aggregate.  ``ranked_pivot`` first reads the largest opportunity number (one
aggregate), and with ``trim`` the distinct (month, number) pairs that carry
money: a list of column names, bounded by 12 x that number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import money_round
from ..operators import pivot, running_index
from ..operators._keys import listify

# Month names in April-first (fiscal) order.
FY_MONTHS = ("April", "May", "June", "July", "August", "September", "October", "November",
             "December", "January", "February", "March")


def month_pivot(df: DataFrame, index, month_col: str, metrics: dict,
                months=FY_MONTHS, label=lambda mo, me: f"{mo} ({me})", fill=0) -> DataFrame:
    """RSH-3 (PIPE-10): one row per index, ``month x metric`` columns, missing = 0."""
    return pivot(df, index, month_col, list(months), metrics, name=label, fill=fill)


def entries_wide(df: DataFrame, index, month_col: str, order, fields,
                 months=FY_MONTHS, skew_safe: bool = False) -> DataFrame:
    """RSH-2 + WIN-1 + PRJ-9 (PIPE-9): the n-th entry of a person in each month
    lands on row n; columns ``{month}_{field}`` for every fiscal month."""
    index = listify(index)
    ranked = running_index(df, index + [month_col], order, out="row_id", skew_safe=skew_safe)
    aggs = {f: F.max(F.col(f)) for f in fields}
    return pivot(ranked, index + ["row_id"], month_col, list(months), aggs,
                 name=lambda mo, f: f"{mo}_{f}")


def value_header(month: str, op_num) -> str:
    return f"Earning Opportunity {op_num} ZAR Value ({month})"


def gig_header(month: str, op_num) -> str:
    return f"# of Gig {op_num} ({month})"


def rank_list(df: DataFrame, rank_col: str, ranks=None) -> list[int]:
    """The opportunity numbers 1..largest; given ``ranks`` are checked to hold every number in use."""
    used = df.agg(F.max(rank_col)).first()[0] or 0
    if ranks is None:
        return list(range(1, used + 1))
    if used > max(ranks, default=0):
        raise ValueError(f"opportunity numbers reach {used}, beyond the listed {list(ranks)}")
    return list(ranks)


def ranked_pivot(df: DataFrame, index, month_col: str, rank_col: str, value: Column,
                 ranks=None, months=FY_MONTHS, trim: bool = False, gigs: Column | None = None) -> DataFrame:
    """RSH-4 + RSH-6 (PIPE-11): one value and one gig column per (month,
    opportunity number), interleaved, ordered by fiscal month then number.
    The numbers come from the data (see ``rank_list``); ``trim`` keeps only
    pairs that carry a non-zero value somewhere.  ``gigs`` counts a row (one when
    not given), for rows that were summed before."""
    ranks = rank_list(df, rank_col, ranks)
    keyed = df.withColumn("__pair", F.concat_ws("|", F.col(month_col), F.col(rank_col).cast("string")))
    pairs = [(mo, r) for mo in months for r in ranks]
    if trim:
        live = {r["__pair"] for r in keyed.filter(value != 0).select("__pair").distinct().collect()}
        pairs = [(mo, r) for mo, r in pairs if f"{mo}|{r}" in live]
    keys = [f"{mo}|{r}" for mo, r in pairs]
    names = {f"{mo}|{r}": (mo, r) for mo, r in pairs}
    # pivot() emits (value, gig) per pair in pair order: already the RSH-6 interleave
    return pivot(keyed, index, "__pair", keys,
                 {"v": F.sum(value.cast("decimal(18,2)")).cast("double"), "g": F.count(F.lit(1)) if gigs is None else F.sum(gigs)},
                 name=lambda k, me: (value_header if me == "v" else gig_header)(*names[k]), fill=0)


# Partner-facing header names of the breakdown sheet.
PARTNER_RENAME = {
    "Full Name": "Name & Surname",
    "id_number": "SA ID Number",
    "first_date": "Date First Earning Opportunity Secured",
    "cellphone_number": "Cell Number",
    "nearest_metro": "Geographic Location (City)",
    "province": "Geographic Location (Province)",
    "cohort": "Cohort",
    "Programme": "Umuzi-PYEI programme (s) participating in",
    "race": "Race",
    "gender": "Gender",
    "earning_opportunity_type": "Earning Opportunities Type",
}


def partner_headers(fy_start: int, months=FY_MONTHS) -> dict[str, str]:
    """SNK-4: column -> partner header.  Opportunity 1 of each month carries the
    year (months from January on belong to the next one); named columns take
    their partner label; every other column keeps its name."""
    dated = {value_header(mo, 1): value_header(f"{mo} {fy_start + (k >= 9)}", 1) for k, mo in enumerate(months)}
    return {**PARTNER_RENAME, **dated}


def summary_long(summary: DataFrame, months=FY_MONTHS) -> DataFrame:
    """The monthly summary as shipped, unpivoted: one (person, month, v, n) row per month column pair."""
    cells = [F.struct(F.lit(mo).alias("month"), F.col(f"`{mo} (Payment)`").cast("double").alias("v"),
                      F.col(f"`{mo} (Count)`").cast("bigint").alias("n")) for mo in months]
    return summary.select("umuzi_email", F.inline(F.array(*cells)))


def breakdown_long(brk: DataFrame, months=FY_MONTHS, keep=()) -> DataFrame:
    """The breakdown as shipped, unpivoted: one (person, month, number, v, n) row per value and
    gig column pair, with the columns ``keep``."""
    own, cells = set(brk.columns), []
    for mo in months:
        number = 1
        last = sum(c.endswith(f"({mo})") for c in own)     # at most so many numbers have a column
        largest = len(own)
        while number <= largest and last:
            if value_header(mo, number) in own:
                cells.append(F.struct(F.lit(mo).alias("month"), F.lit(number).cast("bigint").alias("number"),
                                      F.col(f"`{value_header(mo, number)}`").cast("double").alias("v"), F.col(f"`{gig_header(mo, number)}`").cast("bigint").alias("n")))
                last -= 2
            number += 1
    if not cells:
        return brk.select("umuzi_email", *[F.col(f"`{c}`") for c in keep], F.lit("").alias("month"),
                          F.lit(0).cast("bigint").alias("number"), F.lit(0.0).alias("v"), F.lit(0).cast("bigint").alias("n")).limit(0)
    return brk.select("umuzi_email", *[F.col(f"`{c}`") for c in keep], F.inline(F.array(*cells)))


def partner_export(df: DataFrame, fy_start: int, drop=("umuzi_email",)) -> DataFrame:
    """SNK-4 + PRJ-2/10: drop internal columns, rename headers for the partner."""
    headers = partner_headers(fy_start)
    return df.select(*[F.col(f"`{c}`").alias(headers.get(c, c)) for c in df.columns if c not in set(drop)])


def result_export(df: DataFrame, money_suffix="(Payment)", count_suffix="(Count)") -> DataFrame:
    """SNK-5: money rounded to cents, counts as int -- at export only."""
    cols = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c.endswith(money_suffix):
            col = money_round(col)
        elif c.endswith(count_suffix):
            col = col.cast("int")
        cols.append(col.alias(c))
    return df.select(*cols)
