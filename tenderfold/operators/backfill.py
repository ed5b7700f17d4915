"""Backfill release-model history from the XML staging histories.

The reference reads every migrated ocid, strips the prefix back to the notice
key, and then runs one query per ocid against each staging history table
(avis_history, avis_fournisseurs + fournisseurs, contrats_history,
depenses_history, fournisseurs_history). Here each target is one join of the
history table with the (distinct) notice keys of the migrated releases (J11),
and supplier history fans out through the link and the supplier (J12), one
copy per link row, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderfold import codes
from tenderfold.functions import scalars as X


def _s(c) -> Column:
    return F.coalesce(X.strip(F.col(c) if isinstance(c, str) else c), F.lit(""))


def migrated_keys(releases: DataFrame) -> DataFrame:
    """(ocid, numeroseao) for every release in the target (J11 driver set)."""
    return releases.select("ocid").distinct().select("ocid", X.strip_ocid("ocid").alias("numeroseao"))


def releases_history(keys: DataFrame, avis_history: DataFrame, modified: Column) -> DataFrame:
    """Every archived notice version of a migrated release, as a release version."""
    h = avis_history.withColumn("numeroseao", F.col("numeroseao").cast("string")).join(keys, "numeroseao")
    ntype, nprec, nnat = (X.safe_int(F.col(c)) for c in ("type", "precision", "nature"))
    item_id = X.prefix_before_dash(_s("categorieseao"))
    date = X.strict_ts(F.col("datepublication"))
    return h.select(
        "ocid", _s("numero").alias("release_id"), date.alias("date"), F.lit("avis_history").alias("tag"),
        F.lit("tender_history").alias("initiation_type"), F.lit("fr").alias("language"),
        _s("numero").alias("tender_id"), _s("titre").alias("tender_title"), F.lit("complete").alias("tender_status"),
        X.procurement_method(ntype).alias("tender_procurement_method"),
        X.procurement_method_details(ntype).alias("tender_procurement_method_details"),
        X.main_category(nprec).alias("tender_main_procurement_category"),
        X.additional_categories(nnat).alias("tender_additional_procurement_categories"),
        F.concat(F.lit(codes.BUYER_PREFIX), F.col("numeroseao")).alias("tender_procuring_entity_id"),
        date.alias("tender_start_date"), X.strict_ts(F.col("datefermeture")).alias("tender_end_date"),
        _s("hyperlienseao").alias("tender_documents"), item_id.alias("tender_item_id"),
        _s("categorieseao").alias("tender_item_description"),
        F.lit("UNSPSC").alias("tender_item_classification_scheme"),
        _s("unspscprincipale").alias("tender_item_classification_id"),
        _s("disposition").alias("tender_item_classification_description"),
        F.lit("CATEGORY").alias("tender_item_additional_scheme"), item_id.alias("tender_item_additional_id"),
        _s("categorieseao").alias("tender_item_additional_description"), modified.alias("modified_date"))


def _joined_links(keys: DataFrame, links: DataFrame, fournisseurs: DataFrame) -> DataFrame:
    l = links.withColumn("numeroseao", F.col("numeroseao").cast("string")).join(keys, "numeroseao")
    return l.join(fournisseurs.select("neq").distinct(), "neq")


def _supplier_id() -> Column:
    return F.when(_s("neq") != "", F.concat(F.lit(codes.SUPPLIER_PREFIX), _s("neq"))) \
        .otherwise(F.lit(codes.SUPPLIER_MISSING_ID))


def bids_history(keys: DataFrame, links: DataFrame, fournisseurs: DataFrame, modified: Column) -> DataFrame:
    """One bid version per link row of a migrated notice (not de-duplicated)."""
    j = _joined_links(keys, links, fournisseurs)
    return j.select(_supplier_id().alias("party_id"), "ocid", F.lit(None).cast("string").alias("related_lot"),
                    X.truthy_bit("admissible").alias("admissible"), X.truthy_bit("conforme").alias("conform"),
                    F.coalesce(F.col("montantsoumis"), F.lit(0)).cast("decimal(15,2)").alias("value"),
                    X.bid_unit(F.col("montantssoumisunite")).alias("value_unit"), modified.alias("modified_date"))


def contracts_history(keys: DataFrame, contrats_history: DataFrame, modified: Column,
                      swap_dates: bool = True) -> DataFrame:
    """Archived contract versions (dates swapped as in the migration)."""
    h = contrats_history.withColumn("numeroseao", F.col("numeroseao").cast("string")).join(keys, "numeroseao")
    pub, fin = X.strict_ts(F.col("datepublicationfinale")), X.strict_ts(F.col("datefinale"))
    period_end, signed = (pub, F.coalesce(fin, pub)) if swap_dates else (F.coalesce(fin, pub), pub)
    return h.select(_s("numero").alias("contract_id"), "ocid",
                    X.contract_status("datepublicationfinale").alias("status"), period_end.alias("period_end_date"),
                    F.coalesce(F.col("montantfinal"), F.lit(0)).cast("decimal(15,2)").alias("value_amount"),
                    signed.alias("date_signed"), modified.alias("modified_date"))


def transactions_history(keys: DataFrame, depenses_history: DataFrame, modified: Column,
                         id_col: str = "depense_id") -> DataFrame:
    """U11d: archived expenses as transaction versions ('txn-' + history row id)."""
    h = depenses_history.withColumn("numeroseao", F.col("numeroseao").cast("string")).join(keys, "numeroseao")
    return h.select("ocid", F.concat(F.lit(codes.TRANSACTION_PREFIX), _s(F.col(id_col).cast("string")))
                    .alias("transaction_id"), F.lit(None).cast("string").alias("contract_id"),
                    _s("description").alias("source"), X.strict_ts(F.col("datedepense")).alias("date"),
                    F.coalesce(F.col("montantdepense"), F.lit(0)).cast("decimal(15,2)").alias("value_amount"),
                    F.lit(codes.DEFAULT_CURRENCY).alias("value_currency"), modified.alias("modified_date"))


def parties_history(keys: DataFrame, links: DataFrame, fournisseurs: DataFrame,
                    fournisseurs_history: DataFrame, modified: Column, replicate: bool = False) -> DataFrame:
    """U11e: every archived supplier version with the number of link rows that name its neq.

    The reference writes one equal row per link; here ``multiplicity`` holds
    their number (links are counted per neq before the join), and ``replicate``
    turns it back into rows.
    """
    j = _joined_links(keys, links, fournisseurs).groupBy("neq").agg(F.count("*").alias("multiplicity"))
    fh = fournisseurs_history.where(F.col("neq").isNotNull())
    both = j.join(fh, "neq")
    if replicate:
        both = both.withColumn("multiplicity", F.explode(F.sequence(F.lit(1).cast("long"), F.col("multiplicity"))) * 0 + 1)
    return both.select(
        "multiplicity", _supplier_id().alias("party_id"), _s("nomorganisation").alias("name"),
        F.concat(_s("adresse1"), F.lit(" "), _s("adresse2")).alias("street_address"),
        _s("ville").alias("locality"), _s("province").alias("region"), _s("codepostal").alias("postal_code"),
        _s("pays").alias("country_name"), F.concat(F.lit('{"NEQ": "'), _s("neq"), F.lit('"}')).alias("details"),
        modified.alias("modified_date"))


def backfill(releases: DataFrame, staging: dict[str, DataFrame], staging_history: dict[str, DataFrame],
             modified: Column, with_parties: bool = False, swap_dates: bool = True) -> dict[str, DataFrame]:
    """All U11 targets for the releases present in the target.

    ``staging`` holds avis_fournisseurs and fournisseurs; ``staging_history``
    holds avis, contrats, depenses and (optionally) fournisseurs histories.
    ``with_parties`` selects the variant that also backfills supplier history.
    """
    keys = migrated_keys(releases)
    out = {"releases_history": releases_history(keys, staging_history["avis"], modified),
           "bids_history": bids_history(keys, staging["avis_fournisseurs"], staging["fournisseurs"], modified),
           "contracts_history": contracts_history(keys, staging_history["contrats"], modified, swap_dates)}
    if "depenses" in staging_history:
        out["contract_transactions_history"] = transactions_history(keys, staging_history["depenses"], modified)
    if with_parties and "fournisseurs" in staging_history:
        out["parties_history"] = parties_history(keys, staging["avis_fournisseurs"], staging["fournisseurs"],
                                                 staging_history["fournisseurs"], modified)
    return out
