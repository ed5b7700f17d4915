"""The six analytic questions (AQ1-AQ6) over release-schema tables.

Every function takes the release tables as DataFrames, so the same plan runs on
tables folded from publications and on the driver-table model
(``plans.driver_model``).

Semantics kept from the reference queries:
* AVG of an integer day difference is an integer, truncated toward zero:
  ``sum(d) div count(d)`` (Spark ``div`` truncates toward zero).
* DATEDIFF(day, a, b) counts midnights crossed: ``datediff`` on dates.
* Growth-by-award: the ``AdditionalExpenses IS NOT NULL`` predicate sits in the
  ON clause of the parties join, so it blanks the buyer name, it does not
  filter rows.
* ``ISNULL(SUM(x), 0)`` lives inside the grouped expenses; an ocid without
  transactions therefore has NULL expenses and NULL expected value.

Scale notes:
* "first award / first bid per ocid" is a ``min(struct(order, ...))`` grouped
  aggregate, not a ``row_number`` window: it combines map-side, so an ocid that
  holds a third of all awards is never one task's whole input.
* names are attached to the per-ocid frame (one row per ocid) rather than to
  every contract row, so the parties join sees the smallest input.
* durations are pre-aggregated to (sum, count) before the integer division, so
  a hot group only ever moves one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AMOUNT = "decimal(18,2)"


def day_diff(start: str | Column, end: str | Column) -> Column:
    """DATEDIFF(day, start, end): midnights crossed."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.datediff(F.to_date(e), F.to_date(s))


def int_avg(sum_name: str, cnt_name: str) -> Column:
    """Integer AVG from pre-aggregated parts, truncated toward zero."""
    return F.expr(f"CAST({sum_name} div {cnt_name} AS BIGINT)")


def contract_duration_by_type(contracts: DataFrame, releases: DataFrame) -> DataFrame:
    """AQ1: average contract duration (days) per procurement method details."""
    c = (contracts.where(F.col("date_signed").isNotNull() & F.col("period_end_date").isNotNull())
         .select("ocid", day_diff("date_signed", "period_end_date").alias("d")))
    r = releases.select("ocid", F.col("tender_procurement_method_details").alias("contract_type"))
    return (c.join(r, "ocid")
            .groupBy("contract_type")
            .agg(F.sum("d").alias("_s"), F.count("d").alias("_n"))
            .select("contract_type", int_avg("_s", "_n").alias("average_duration_days"))
            .orderBy("contract_type"))


def contract_duration_by_supplier(contracts: DataFrame, releases: DataFrame,
                                  release_parties: DataFrame, parties: DataFrame) -> DataFrame:
    """AQ2: contracts and average duration per supplier party.

    The three ocid joins share one partitioning; aggregation by party_id runs
    before the names are attached (party_id is the parties key), so the parties
    join sees one row per supplier.
    """
    c = (contracts.where(F.col("date_signed").isNotNull() & F.col("period_end_date").isNotNull())
         .select("ocid", "contract_id", day_diff("date_signed", "period_end_date").alias("d")))
    r = releases.select("ocid")
    rp = release_parties.where(F.col("role") == "supplier").select("ocid", "party_id")
    per_party = (c.join(r, "ocid").join(rp, "ocid")
                 .groupBy("party_id")
                 .agg(F.count_distinct("contract_id").alias("number_of_contracts"),
                      F.sum("d").alias("_s"), F.count("d").alias("_n")))
    p = parties.select("party_id", F.col("name").alias("supplier_name"))
    return (per_party.join(p, "party_id")
            .select("party_id", "supplier_name", "number_of_contracts",
                    int_avg("_s", "_n").alias("average_duration_days"))
            .orderBy(F.col("number_of_contracts").desc()))


def expenses_per_ocid(transactions: DataFrame) -> DataFrame:
    """ISNULL(SUM(value_amount), 0) per ocid."""
    return (transactions.groupBy("ocid")
            .agg(F.coalesce(F.sum("value_amount"), F.lit(0)).cast(AMOUNT).alias("additional_expenses")))


def first_award_per_ocid(awards: DataFrame, release_parties: DataFrame) -> DataFrame:
    """W1 + F5: the award with the smallest award_id per ocid, with its buyer.

    Ties between several buyers of one ocid are broken by party_id (the
    reference leaves them unspecified).
    """
    buyers = release_parties.where(F.col("role") == "buyer").select("ocid", F.col("party_id").alias("buyer_id"))
    first = (awards.select("ocid", "award_id", "value_amount")
             .join(buyers, "ocid")
             .groupBy("ocid")
             .agg(F.min(F.struct("award_id", "buyer_id", "value_amount")).alias("_f")))
    return first.select("ocid", F.col("_f.buyer_id").alias("buyer_id"),
                        F.col("_f.value_amount").cast(AMOUNT).alias("initial_award"))


def growth_first_award(contracts: DataFrame, awards: DataFrame, release_parties: DataFrame,
                       parties: DataFrame, transactions: DataFrame) -> DataFrame:
    """AQ3: contract growth against the first award, per buyer."""
    fa = first_award_per_ocid(awards, release_parties)
    e = expenses_per_ocid(transactions)
    names = parties.select(F.col("party_id").alias("buyer_id"), F.col("name").alias("_buyer_name"))
    # names go onto the per-ocid first awards; every later join is a left join
    # on the contracts' ocid, so one hash partitioning serves all of them. The
    # name is blanked when the expenses are null (the ON-clause predicate of
    # the reference query).
    fa_named = fa.join(names, "buyer_id", "left")
    fc = contracts.select("ocid", F.col("value_amount").cast(AMOUNT).alias("final_contract"))
    out = (fc.join(fa_named, "ocid", "left").join(e, "ocid", "left")
           .withColumn("buyer_name", F.when(F.col("additional_expenses").isNotNull(), F.col("_buyer_name")))
           .select("ocid", "buyer_id", "buyer_name", "initial_award", "additional_expenses",
                   (F.col("initial_award") + F.col("additional_expenses")).cast(AMOUNT)
                   .alias("expected_final_contract"),
                   "final_contract",
                   (F.col("final_contract") - F.col("initial_award")).cast(AMOUNT).alias("growth"))
           .distinct())
    return out.orderBy(F.col("initial_award").desc())


def first_bid_per_ocid(bids: DataFrame, release_parties: DataFrame, order_col: str = "bid_row_id") -> DataFrame:
    """W2 + F5: the earliest-inserted bid per ocid whose party is a supplier of it."""
    sup = release_parties.where(F.col("role") == "supplier").select("ocid", "party_id")
    first = (bids.select("ocid", "party_id", order_col, "value")
             .join(sup, ["ocid", "party_id"])
             .groupBy("ocid")
             .agg(F.min(F.struct(F.col(order_col).alias("o"), "party_id", "value")).alias("_f")))
    return first.select("ocid", F.col("_f.party_id").alias("supplier_id"),
                        F.col("_f.value").cast(AMOUNT).alias("initial_bid"))


def growth_first_bid(contracts: DataFrame, bids: DataFrame, release_parties: DataFrame,
                     parties: DataFrame, transactions: DataFrame, order_col: str = "bid_row_id") -> DataFrame:
    """AQ4: final contract value against the first bid, per supplier."""
    fb = first_bid_per_ocid(bids, release_parties, order_col)
    e = expenses_per_ocid(transactions)
    names = parties.select(F.col("party_id").alias("supplier_id"), F.col("name").alias("supplier_name"))
    fb_named = fb.join(names, "supplier_id", "left")
    fc = contracts.select("ocid", F.col("value_amount").cast(AMOUNT).alias("final_contract"))
    out = (fc.join(fb_named, "ocid", "left").join(e, "ocid", "left")
           .select("ocid", "supplier_id", "supplier_name", "initial_bid", "additional_expenses",
                   (F.col("initial_bid") + F.col("additional_expenses")).cast(AMOUNT)
                   .alias("expected_final_contract"),
                   "final_contract")
           .distinct())
    return out.orderBy("ocid")


def tender_duration_by_type(releases: DataFrame) -> DataFrame:
    """AQ5: average tender duration (days) per procurement method details."""
    return (releases.where(F.col("tender_start_date").isNotNull() & F.col("tender_end_date").isNotNull())
            .select(F.col("tender_procurement_method_details").alias("tender_type"),
                    day_diff("tender_start_date", "tender_end_date").alias("d"))
            .groupBy("tender_type")
            .agg(F.sum("d").alias("_s"), F.count("d").alias("_n"))
            .select("tender_type", int_avg("_s", "_n").alias("average_tender_duration_days"))
            .orderBy("tender_type"))


def tender_duration_by_buyer(releases: DataFrame, release_parties: DataFrame, parties: DataFrame) -> DataFrame:
    """AQ6: tenders and average tender duration per buyer name.

    The count is distinct over release_id; the average is over joined rows, as
    in the reference (a release with two buyer rows of one name counts twice in
    the average). Rows are reduced to (party, release) partials before the
    names are attached.
    """
    r = (releases.where(F.col("tender_start_date").isNotNull() & F.col("tender_end_date").isNotNull())
         .select("ocid", "release_id", day_diff("tender_start_date", "tender_end_date").alias("d")))
    rp = release_parties.where(F.col("role") == "buyer").select("ocid", "party_id")
    partial = (r.join(rp, "ocid")
               .groupBy("party_id", "release_id")
               .agg(F.sum("d").alias("_s"), F.count("d").alias("_n")))
    p = parties.select("party_id", F.col("name").alias("client_name"))
    return (partial.join(p, "party_id")
            .groupBy("client_name")
            .agg(F.count_distinct("release_id").alias("number_of_tenders"),
                 F.sum("_s").alias("_s"), F.sum("_n").alias("_n"))
            .select("client_name", "number_of_tenders",
                    int_avg("_s", "_n").alias("average_tender_duration_days"))
            .orderBy(F.col("average_tender_duration_days").desc()))
