"""P15-P20 + U9 + A4: staging tables -> release tables under a migration ``Policy``.

The reference migrates notice by notice (an N+1 loop of supplier queries) and
upserts row by row. Here each target is one set-based plan:

* notices, contracts and expenses are selected by the policy (semi joins);
* every party write (buyer of a notice, supplier of a link) is resolved by
  exact name (U9): the first candidate id of a name wins, address and details
  follow the last writer; names whose candidate id is taken are conflicts;
* supplier links join suppliers on neq (J1, so neq-less links drop out);
* bids, contracts and transactions are last-write-wins per key, and every
  superseded write is kept as history; awards
  (first policy only) are insert-if-absent on award_id = notice number, so the
  first winner's amounts stay and later winners only add supplier links;
* the tenderer count per release is the number of joined links (A4).

Write order (for "first"/"last"): notices by numeroseao, then link position,
as the staging queries carry no ORDER BY.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderfold import codes
from tenderfold.functions import scalars as X
from tenderfold.operators import versionlog as V
from tenderfold.operators.identity import name_ids, resolve_by_name
from tenderfold.operators.policies import Policy, select_staging, stub_releases


def _s(c) -> F.Column:
    """safe_str: NULL/'' -> '', else trimmed text."""
    return F.coalesce(X.strip(F.col(c) if isinstance(c, str) else c), F.lit(""))


def _versions(rows: DataFrame, key) -> tuple[DataFrame, DataFrame]:
    """(last write per key, the writes it superseded): every update archives the row before it."""
    cls = V.classify(rows, key, kind=None)
    return (cls.where(F.col("state") == V.CURRENT).drop("state", "seq"),
            cls.where(F.col("state") == V.HISTORY).drop("state", "seq"))


def migrate(policy: Policy, avis: DataFrame, links: DataFrame, fournisseurs: DataFrame,
            contrats: DataFrame, depenses: DataFrame, existing_parties: DataFrame | None = None
            ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Return ({release table: rows written by the migration}, party-id conflicts).

    ``existing_parties`` (the target's current parties) take part in the name
    lookup as the earliest writers, so a name already in the target keeps its id.
    With a target, pass the result to ``apply_to_target``.
    """
    notices, contracts, expenses = select_staging(policy, avis, contrats, depenses)
    ocid = X.build_ocid(F.col("numeroseao").cast("string"))
    order = F.col("numeroseao").cast("string")

    # ---- party writes (buyers, then each notice's suppliers) --------------------
    buyer_w = notices.select(
        ocid.alias("ocid"), F.concat(F.lit(codes.BUYER_PREFIX), _s(F.col("numeroseao").cast("string"))).alias("cand"),
        _s("organisme").alias("name"),
        F.concat(_s("adresse1"), F.lit(" "), _s("adresse2")).alias("street_address"),
        _s("ville").alias("locality"), _s("province").alias("region"), _s("codepostal").alias("postal_code"),
        _s("pays").alias("country_name"),
        F.concat(F.lit('{"Municipal": "'), F.when(F.col("municipal").cast("int") != 0, F.lit("1")).otherwise(F.lit("0")),
                 F.lit('"}')).alias("details"),
        F.lit("buyer").alias("role"),
        F.struct(order.alias("n"), F.lit(-1).alias("p"), F.lit("").alias("c")).alias("seq"))
    sel_links = links.join(notices.select("numeroseao"), "numeroseao", "left_semi")
    joined = sel_links.select("numeroseao", "neq", "link_pos", "adjudicataire", "admissible", "conforme",
                              "montantsoumis", "montantssoumisunite", "montantcontrat", "montanttotalcontrat") \
        .join(fournisseurs.select("neq", F.col("nomorganisation").alias("f_name"), "adresse1", "adresse2", "ville",
                                  "province", "pays", "codepostal"), "neq")
    supplier_w = joined.select(
        ocid.alias("ocid"),
        F.when(_s("neq") != "", F.concat(F.lit(codes.SUPPLIER_PREFIX), _s("neq")))
        .otherwise(F.lit(codes.SUPPLIER_MISSING_ID)).alias("cand"),
        _s("f_name").alias("name"), F.concat(_s("adresse1"), F.lit(" "), _s("adresse2")).alias("street_address"),
        _s("ville").alias("locality"), _s("province").alias("region"), _s("codepostal").alias("postal_code"),
        _s("pays").alias("country_name"),
        F.concat(F.lit('{"NEQ": "'), _s("neq"), F.lit('"}')).alias("details"),
        F.when(F.col("adjudicataire").cast("int") == 1, F.lit("supplier")).otherwise(F.lit("tenderer")).alias("role"),
        F.struct(order.alias("n"), F.col("link_pos").cast("int").alias("p"), _s("neq").alias("c")).alias("seq"),
        X.truthy_bit("admissible").alias("admissible"), X.truthy_bit("conforme").alias("conform"),
        F.coalesce(F.col("montantsoumis"), F.lit(0)).cast("decimal(15,2)").alias("value"),
        X.bid_unit(F.col("montantssoumisunite"), policy.bid_unit_blank_is_missing).alias("value_unit"),
        (F.col("adjudicataire").cast("int") == 1).alias("winner"),
        F.coalesce(F.col("montantcontrat"), F.lit(0)).cast("decimal(15,2)").alias("award_amount"),
        F.coalesce(F.col("montanttotalcontrat"), F.lit(0)).cast("decimal(15,2)").alias("award_total"))
    pcols = ["ocid", "cand", "name", "street_address", "locality", "region", "postal_code", "country_name",
             "details", "role", "seq"]
    writes = buyer_w.select(*pcols).unionByName(supplier_w.select(*pcols))
    if existing_parties is not None:
        # the target's parties answer the name lookup first (ties: smallest id)
        prior = existing_parties.select(
            F.lit(None).cast("string").alias("ocid"), F.col("party_id").alias("cand"), _s("name").alias("name"),
            *[F.col(c) for c in ("street_address", "locality", "region", "postal_code", "country_name", "details")],
            F.lit(None).cast("string").alias("role"),
            F.struct(F.lit("").alias("n"), F.lit(-2).alias("p"), F.col("party_id").alias("c")).alias("seq"))
        writes = prior.unionByName(writes)
    last_cols = ["street_address", "locality", "region", "postal_code", "country_name", "details"]
    resolved, conflicts = resolve_by_name(writes, "name", "cand", "seq", last_writer_cols=last_cols)
    parties = (resolved.groupBy("party_id").agg(F.min_by("name", "seq").alias("name"),
                                               *[F.max_by(f"last_{c}", "seq").alias(c) for c in last_cols]))
    if existing_parties is not None:
        # only parties the migration wrote to; untouched target parties stay as they are
        touched = resolved.where(F.col("role").isNotNull()).select("party_id").distinct()
        parties = parties.join(touched, "party_id", "left_semi")
    release_parties = resolved.where(F.col("role").isNotNull()).select("ocid", "party_id", "role").distinct()
    party_versions = resolved.where(F.col("role").isNotNull()).select(
        "party_id", "name", *[F.col(c) for c in last_cols], "seq")
    buyer_ids = resolved.where(F.col("role") == "buyer").select("ocid", F.col("party_id").alias("buyer_party_id"))

    # ---- releases (P15) + tenderer count (A4) -------------------------------------
    ntype, nprec, nnat = (X.safe_int(F.col(c)) for c in ("type", "precision", "nature"))
    item_id = X.prefix_before_dash(_s("categorieseao"))
    date = X.strict_ts(F.col("datepublication"))
    counts = supplier_w.groupBy("ocid").agg(F.count(F.lit(1)).cast("int").alias("n"))
    releases = (notices.select(
        ocid.alias("ocid"), _s("numero").alias("release_id"), date.alias("date"), F.lit("avis").alias("tag"),
        F.lit("tender").alias("initiation_type"), F.lit("fr").alias("language"), _s("numero").alias("tender_id"),
        _s("titre").alias("tender_title"), F.lit("complete").alias("tender_status"),
        X.procurement_method(ntype).alias("tender_procurement_method"),
        X.procurement_method_details(ntype).alias("tender_procurement_method_details"),
        X.main_category(nprec).alias("tender_main_procurement_category"),
        X.additional_categories(nnat).alias("tender_additional_procurement_categories"),
        date.alias("tender_start_date"), X.strict_ts(F.col("datefermeture")).alias("tender_end_date"),
        _s("hyperlienseao").alias("tender_documents"), item_id.alias("tender_item_id"),
        _s("categorieseao").alias("tender_item_description"),
        F.lit("UNSPSC").alias("tender_item_classification_scheme"),
        _s("unspscprincipale").alias("tender_item_classification_id"),
        _s("disposition").alias("tender_item_classification_description"),
        F.lit("CATEGORY").alias("tender_item_additional_scheme"), item_id.alias("tender_item_additional_id"),
        _s("categorieseao").alias("tender_item_additional_description"),
        F.struct(order.alias("n")).alias("seq"))
        .join(buyer_ids, "ocid", "left").join(counts, "ocid", "left")
        .withColumn("tender_procuring_entity_id", F.col("buyer_party_id"))
        .withColumn("tender_number_of_tenderers", F.coalesce(F.col("n"), F.lit(0)))
        .drop("buyer_party_id", "n"))
    releases, releases_old = _versions(releases, "ocid")

    # ---- bids, awards -------------------------------------------------------------
    # a write's party is that of its name: the names' ids are joined to the writes themselves, not the resolved writes to them
    sw = supplier_w.join(name_ids(writes, "name", "cand", "seq"), "name")
    bids, bids_old = _versions(sw.select("party_id", "ocid", F.lit(None).cast("string").alias("related_lot"), "admissible",
                                         "conform", "value", "value_unit", "seq"), ["party_id", "ocid"])
    out = {"releases": releases, "parties": parties, "release_parties": release_parties, "bids": bids,
           "party_versions": party_versions, "releases_history": releases_old, "bids_history": bids_old}
    if policy.build_awards:
        win = sw.where("winner").join(notices.select(ocid.alias("ocid"), _s("numero").alias("award_id")), "ocid")
        first = win.groupBy("award_id").agg(F.min_by(F.struct("ocid", "award_amount", "award_total"), "seq").alias("f"))
        out["awards"] = first.select("award_id", F.col("f.ocid").alias("ocid"), F.lit("active").alias("status"),
                                     F.col("f.award_amount").alias("value_amount"),
                                     F.lit(codes.DEFAULT_CURRENCY).alias("value_currency"),
                                     F.col("f.award_total").alias("value_total_amount"))
        out["suppliers_awards"] = (win.groupBy("award_id", F.col("party_id").alias("supplier_id"))
                                   .agg(F.min_by("ocid", "seq").alias("supplier_ocid")))

    # ---- contracts (P18), transactions (P19), stubs (P20) ---------------------------
    pub, fin = X.strict_ts(F.col("datepublicationfinale")), X.strict_ts(F.col("datefinale"))
    period_end, signed = (pub, F.coalesce(fin, pub)) if policy.swap_dates else (F.coalesce(fin, pub), pub)
    out["contracts"], out["contracts_history"] = _versions(contracts.select(
        _s("numero").alias("contract_id"), ocid.alias("ocid"), X.contract_status("datepublicationfinale").alias("status"),
        period_end.alias("period_end_date"), F.coalesce(F.col("montantfinal"), F.lit(0)).cast("decimal(15,2)")
        .alias("value_amount"), signed.alias("date_signed"),
        F.struct(order.alias("n"), _s("numero").alias("c")).alias("seq")), "contract_id")
    out["contract_transactions"], out["contract_transactions_history"] = _versions(expenses.select(
        ocid.alias("ocid"), F.concat(F.lit(codes.TRANSACTION_PREFIX), _s("depense_id")).alias("transaction_id"),
        F.lit(None).cast("string").alias("contract_id"), _s("description").alias("source"),
        X.strict_ts(F.col("datedepense")).alias("date"),
        F.coalesce(F.col("montantdepense"), F.lit(0)).cast("decimal(15,2)").alias("value_amount"),
        F.lit(codes.DEFAULT_CURRENCY).alias("value_currency"),
        F.struct(order.alias("n"), _s("depense_id").alias("d")).alias("seq")),
        ["ocid", "transaction_id"])
    if policy.stub_releases:
        out["stub_releases"] = stub_releases(notices, contracts, expenses)
    return out, conflicts


# tables whose history the first two migrations delete afterwards (SNK3)
CLEARED_HISTORIES = ["bids", "contract_transactions", "contracts", "parties", "release_parties", "releases"]


def stub_rows(stubs: DataFrame) -> DataFrame:
    """P20: stub releases as rows of ``releases``."""
    return stubs.select("ocid", "release_id", "tag", F.lit("tender").alias("initiation_type"), F.lit("fr").alias("language"))


def _empty_like(df: DataFrame) -> DataFrame:
    return df.limit(0)


def apply_to_target(policy: Policy, target: dict[str, DataFrame], migrated: dict[str, DataFrame],
                    modified: F.Column, target_history: dict[str, DataFrame] | None = None
                    ) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Write a migration onto an existing release target (JSON loads and the
    migration share one target in the reference).

    Returns {table: (current, history)}. Rules, all joins on the table key:

    * upserts overwrite the migrated columns and keep the columns the
      migration never writes (rationale and duration of releases, award id and
      currency of contracts, aliases and role of parties);
    * each superseded target row becomes a history row; a migrated release is
      written twice (its fields, then the tenderer count), so the intermediate
      version is history too;
    * bids update every target bid of (party, ocid), whatever its lot, and
      insert a lot-less bid otherwise; awards, award links, role links and stub
      releases are insert-if-absent;
    * ``policy.clear_history`` empties the six cleared history tables (SNK3),
      including rows written before the migration.
    """
    hist_in = target_history or {}
    out: dict[str, tuple[DataFrame, DataFrame]] = {}

    def finish(name: str, cur: DataFrame, delta: DataFrame | None) -> None:
        prev = hist_in.get(name)
        if policy.clear_history and name in CLEARED_HISTORIES:
            h = _empty_like(prev if prev is not None else (delta if delta is not None else cur))
        elif delta is None:
            h = prev
        else:
            h = delta if prev is None else prev.unionByName(delta, allowMissingColumns=True)
        out[name] = (cur, h)

    def upsert(name: str, key: list[str]) -> tuple[DataFrame, DataFrame]:
        tgt, new = target[name], migrated[name]
        carried = [c for c in tgt.columns if c not in new.columns]
        new_full = new.join(tgt.select(*key, *carried), key, "left")
        cur = (tgt.join(new.select(*key), key, "left_anti")
               .unionByName(new_full, allowMissingColumns=True))
        superseded = tgt.join(new.select(*key), key, "left_semi").withColumn("modified_date", modified)
        return cur, superseded

    def own_versions(name: str, key: list[str]) -> DataFrame:
        """Versions that the migration itself superseded, with the columns it never writes."""
        tgt, old = target[name], migrated[f"{name}_history"]
        carried = [c for c in tgt.columns if c not in old.columns]
        return old.join(tgt.select(*key, *carried), key, "left").withColumn("modified_date", modified)

    def insert_if_absent(name: str, key: list[str], rows: DataFrame | None = None) -> DataFrame:
        tgt = target[name]
        add = (rows if rows is not None else migrated[name]).join(tgt.select(*key), key, "left_anti")
        return tgt.unionByName(add, allowMissingColumns=True)

    # releases (+ the count update's intermediate version, + stubs)
    cur, superseded = upsert("releases", ["ocid"])
    old_count = target["releases"].select("ocid", F.col("tender_number_of_tenderers").alias("__old_n"))
    intermediate = (migrated["releases"].join(old_count, "ocid", "left")
                    .withColumn("tender_number_of_tenderers", F.col("__old_n")).drop("__old_n")
                    .join(target["releases"].select("ocid", *[c for c in target["releases"].columns
                                                              if c not in migrated["releases"].columns]),
                          "ocid", "left")
                    .withColumn("modified_date", modified))
    delta = (superseded.unionByName(intermediate, allowMissingColumns=True)
             .unionByName(own_versions("releases", ["ocid"]), allowMissingColumns=True))
    if "stub_releases" in migrated:
        stubs = stub_rows(migrated["stub_releases"])
        cur = cur.unionByName(stubs.join(cur.select("ocid"), "ocid", "left_anti"), allowMissingColumns=True)
    finish("releases", cur, delta)

    # parties: every write to a party is a version (the target row first)
    tp = target["parties"]
    vcols = ["party_id", "name", "street_address", "locality", "region", "postal_code", "country_name", "details"]
    first = tp.select(*vcols, F.struct(F.lit("").alias("n"), F.lit(-2).alias("p"), F.col("party_id").alias("c"))
                      .alias("seq"))
    versions = first.unionByName(migrated["party_versions"].select(*vcols, "seq"))
    cls = V.classify(versions, "party_id", kind=None)
    keep = [c for c in tp.columns if c not in vcols]
    names = versions.groupBy("party_id").agg(F.min_by("name", "seq").alias("__name"))
    pcur = (cls.where(F.col("state") == V.CURRENT).drop("state", "seq")
            .join(names, "party_id").withColumn("name", F.col("__name")).drop("__name")
            .join(tp.select("party_id", *keep), "party_id", "left"))
    phist = (cls.where(F.col("state") == V.HISTORY).drop("state", "seq")
             .join(names, "party_id").withColumn("name", F.col("__name")).drop("__name")
             .join(tp.select("party_id", *keep), "party_id", "left").withColumn("modified_date", modified))
    finish("parties", pcur, phist)

    finish("release_parties", insert_if_absent("release_parties", ["ocid", "party_id", "role"]), None)

    # bids: update every target bid of (party, ocid); insert when there is none
    tb, nb = target["bids"], migrated["bids"]
    setc = ["admissible", "conform", "value", "value_unit"]
    hit = tb.join(nb.select("party_id", "ocid", *[F.col(c).alias(f"__n_{c}") for c in setc]), ["party_id", "ocid"])
    updated = hit.select(*[F.col(f"__n_{c}").alias(c) if c in setc else F.col(c) for c in tb.columns])
    bcur = (tb.join(nb.select("party_id", "ocid"), ["party_id", "ocid"], "left_anti")
            .unionByName(updated)
            .unionByName(nb.join(tb.select("party_id", "ocid").distinct(), ["party_id", "ocid"], "left_anti"),
                         allowMissingColumns=True))
    bhist = tb.join(nb.select("party_id", "ocid"), ["party_id", "ocid"], "left_semi").withColumn("modified_date", modified)
    finish("bids", bcur, bhist.unionByName(migrated["bids_history"].withColumn("modified_date", modified),
                                           allowMissingColumns=True))

    if "awards" in migrated:
        finish("awards", insert_if_absent("awards", ["award_id"]), None)
        finish("suppliers_awards", insert_if_absent("suppliers_awards", ["award_id", "supplier_id"]), None)
    for name, key in (("contracts", ["contract_id"]), ("contract_transactions", ["ocid", "transaction_id"])):
        cur, superseded = upsert(name, key)
        finish(name, cur, superseded.unionByName(own_versions(name, key), allowMissingColumns=True))
    for name in target:
        if name not in out:
            out[name] = (target[name], hist_in.get(name))
    return out
