"""Nested release documents (and notice XML) built from flat tables.

Documents are assembled per release with ``collect_list`` over the release's
own children (a bounded group: one release's contracts), then serialised with
``to_json`` / XML text. The round trip through the readers is how the driver
checks the reader side (SRC1-SRC3) on data that grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"


def contract_documents(contracts: DataFrame) -> DataFrame:
    """(file_name, value) with one ``{"releases": [...]}`` document per ocid
    holding only its contracts (the lightweight form of ``release_documents``).

    ``contracts`` needs ocid, contract_id, award_id, value_amount, currency and
    date_signed (text); an optional ``order`` column fixes the array order.
    """
    c = F.struct(F.col("contract_id").alias("id"), F.col("award_id").alias("awardID"),
                 F.struct(F.col("value_amount").alias("amount"), F.col("currency").alias("currency")).alias("value"),
                 F.col("date_signed").alias("dateSigned"))
    if "order" in contracts.columns:
        lst = F.transform(F.array_sort(F.collect_list(F.struct(F.col("order").alias("o"), c.alias("c")))),
                          lambda e: e["c"])
    else:                                   # element order not needed by the caller
        lst = F.collect_list(c)
    per = contracts.groupBy("ocid").agg(lst.alias("l"))
    rel = F.struct(F.col("ocid").alias("ocid"), F.col("ocid").alias("id"), F.col("l").alias("contracts"))
    return per.select(F.concat(F.lit("doc_"), F.col("ocid"), F.lit(".json")).alias("file_name"),
                      F.to_json(F.struct(F.array(rel).alias("releases"))).alias("value"))


def _el(tag: str, v) -> F.Column:
    return F.concat(F.lit(f"<{tag}>"), F.coalesce(v.cast("string"), F.lit("")), F.lit(f"</{tag}>"))


def notice_xml_documents(notices: DataFrame, suppliers: DataFrame) -> DataFrame:
    """(file_name, text) with one ``<export><avis>..</avis></export>`` per notice.

    Text is written unescaped (a bare ``&`` stays bare), like the publisher's files.
    """
    f = F.concat(F.lit("<fournisseur>"), _el("neq", F.col("neq")), _el("nomorganisation", F.col("nomorganisation")),
                 _el("montantsoumis", F.col("montantsoumis")), _el("adjudicataire", F.col("adjudicataire")),
                 F.lit("</fournisseur>"))
    if "order" in suppliers.columns:
        lst = F.transform(F.array_sort(F.collect_list(F.struct(F.col("order").alias("o"), f.alias("x")))),
                          lambda e: e["x"])
    else:                                   # element order not needed by the caller
        lst = F.collect_list(f)
    per = suppliers.groupBy("numeroseao").agg(lst.alias("l"))
    doc = (notices.join(per, "numeroseao", "left")
           .select(F.concat(F.lit("avis_"), F.col("numeroseao").cast("string"), F.lit(".xml")).alias("file_name"),
                   F.concat(F.lit("<export><avis>"), _el("numeroseao", F.col("numeroseao")),
                            _el("organisme", F.col("organisme")), F.lit("<fournisseurs>"),
                            F.coalesce(F.array_join("l", ""), F.lit("")),
                            F.lit("</fournisseurs></avis></export>")).alias("text")))
    return doc


def _iso(c: str) -> F.Column:
    return F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss")


def _list(df: DataFrame, key: str, element: F.Column, name: str) -> DataFrame:
    """(key, name): the rows of one release (or contract, award) as an array."""
    return df.groupBy(key).agg(F.collect_list(element).alias(name))


def _split(c: str) -> F.Column:
    return F.when(F.coalesce(F.col(c), F.lit("")) != "", F.split(F.col(c), ",", -1)) \
        .otherwise(F.array().cast("array<string>"))


def release_documents(t: dict[str, DataFrame]) -> DataFrame:
    """One nested release document per ocid from the 11 release tables.

    Shape follows the release-JSON files the loader reads (so the documents
    read back through ``sources.release_json``): tender with its single item,
    additional classification, documents and lots; parties with roles; bids at
    release level (one per stored bid row, its lot as the only related lot);
    awards with suppliers; contracts with amendments and transactions; related
    processes. Every child is collected per ocid (one release's rows, a
    bounded group) and joined on ocid, so all joins share one partitioning.
    Returns (ocid, file_name, value).

    Lots have a global key: a lot re-published by another release belongs to
    that release now, so a bid that cites it from its first release fails the
    foreign-key check when the documents are read back, as it would in the
    reference.
    """
    r = t["releases"]
    roles = t["release_parties"].groupBy("ocid", "party_id").agg(F.collect_list("role").alias("roles"))
    parties = (roles.join(t["parties"], "party_id")
               .select("ocid", F.struct(
                   F.col("party_id").alias("id"), "name",
                   F.struct(F.col("street_address").alias("streetAddress"), "locality", "region",
                            F.col("postal_code").alias("postalCode"),
                            F.col("country_name").alias("countryName")).alias("address"),
                   "details", "roles").alias("p")))
    parties = _list(parties, "ocid", F.col("p"), "parties")
    lots = _list(t["lots"], "ocid", F.struct(
        F.col("lot_id").alias("id"), "title", "status",
        F.struct(_iso("contract_period_start_date").alias("startDate"),
                 _iso("contract_period_end_date").alias("endDate")).alias("contractPeriod")), "lots")
    bids = _list(t["bids"], "ocid", F.struct(
        F.col("party_id").alias("id"),
        F.when(F.col("related_lot").isNotNull(), F.array("related_lot")).alias("relatedLots"),
        F.col("admissible").cast("string").alias("admissible"), F.col("conform").cast("string").alias("conform"),
        "value", F.col("value_unit").alias("valueUnit")), "bids")
    names = t["parties"].select(F.col("party_id").alias("supplier_id"), "name")
    sup = (t["suppliers_awards"].join(names, "supplier_id", "left")
           .groupBy("award_id", F.col("supplier_ocid").alias("ocid"))
           .agg(F.collect_list(F.struct(F.col("supplier_id").alias("id"), "name")).alias("suppliers")))
    awards = _list(t["awards"].join(sup, ["award_id", "ocid"], "left"), "ocid", F.struct(
        F.col("award_id").alias("id"), "status", _iso("date").alias("date"),
        F.struct(F.col("value_amount").alias("amount"), F.col("value_total_amount").alias("totalAmount"),
                 F.col("value_currency").alias("currency")).alias("value"), "suppliers"), "awards")
    amend = _list(t["contract_amendments"], "contract_id", F.struct(
        F.col("amendment_id").alias("id"), "rationale", _iso("amendment_date").alias("date")), "amendments")
    txns = _list(t["contract_transactions"], "contract_id", F.struct(
        F.col("transaction_id").alias("id"), "source", _iso("date").alias("date"),
        F.struct(F.col("value_amount").alias("amount"), F.col("value_currency").alias("currency")).alias("value")),
        "transactions")
    contracts = _list(t["contracts"].join(amend, "contract_id", "left").join(txns, "contract_id", "left"),
                      "ocid", F.struct(
                          F.col("contract_id").alias("id"), F.col("award_id").alias("awardID"), "status",
                          F.struct(_iso("period_end_date").alias("endDate")).alias("period"),
                          F.struct(F.col("value_amount").alias("amount"),
                                   F.col("value_currency").alias("currency")).alias("value"),
                          _iso("date_signed").alias("dateSigned"), "amendments",
                          F.struct(F.col("transactions").alias("transactions")).alias("implementation")),
                      "contracts")
    related = _list(t["related_processes"], "ocid", F.struct(
        "id", "identifier", "uri", "title", "scheme", _split("relationship").alias("relationship")),
        "relatedProcesses")
    item = F.when(F.col("tender_item_id") != "", F.array(F.struct(
        F.col("tender_item_id").alias("id"), F.col("tender_item_description").alias("description"),
        F.struct(F.col("tender_item_classification_scheme").alias("scheme"),
                 F.col("tender_item_classification_id").alias("id"),
                 F.col("tender_item_classification_description").alias("description")).alias("classification"),
        F.when(F.col("tender_item_additional_id") != "", F.array(F.struct(
            F.col("tender_item_additional_scheme").alias("scheme"), F.col("tender_item_additional_id").alias("id"),
            F.col("tender_item_additional_description").alias("description"))))
        .alias("additionalClassifications"))))
    docs = F.transform(_split("tender_documents"), lambda u: F.struct(u.alias("url")))
    j = r
    for child in (parties, lots, bids, awards, contracts, related):
        j = j.join(child, "ocid", "left")
    release = F.struct(
        F.col("ocid"), F.col("release_id").alias("id"), _iso("date").alias("date"), _split("tag").alias("tag"),
        F.col("initiation_type").alias("initiationType"), "language",
        F.struct(F.col("tender_id").alias("id"), F.col("tender_title").alias("title"),
                 F.col("tender_status").alias("status"), F.col("tender_procurement_method").alias("procurementMethod"),
                 F.col("tender_procurement_method_details").alias("procurementMethodDetails"),
                 F.col("tender_procurement_method_rationale").alias("procurementMethodRationale"),
                 F.col("tender_main_procurement_category").alias("mainProcurementCategory"),
                 _split("tender_additional_procurement_categories").alias("additionalProcurementCategories"),
                 F.struct(F.col("tender_procuring_entity_id").alias("id")).alias("procuringEntity"),
                 F.struct(_iso("tender_start_date").alias("startDate"), _iso("tender_end_date").alias("endDate"),
                          F.col("tender_duration_in_days").alias("durationInDay")).alias("tenderPeriod"),
                 F.col("tender_number_of_tenderers").alias("numberOfTenderers"), docs.alias("documents"),
                 item.alias("items"), F.col("lots")).alias("tender"),
        "parties", "bids", "awards", "contracts", "relatedProcesses")
    return j.select("ocid", F.concat(F.lit("release_"), F.col("ocid"), F.lit(".json")).alias("file_name"),
                    F.to_json(F.struct(F.array(release).alias("releases"))).alias("value"))
