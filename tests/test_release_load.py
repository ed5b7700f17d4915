from pyspark.sql import functions as F

from tenderfold.plans.load import load_release_json, read_tables
from tests.fixtures import write_release_files


def _load(spark, d, out):
    paths = load_release_json(spark, d, out, batch_ts="2024-01-01 00:00:00")
    t = read_tables(spark, paths)
    tables = {k: (t[k], t[f"{k}_history"]) for k in t if k != "rejects" and not k.endswith("_history")}
    return tables, t["rejects"]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_release_load(spark, tmp_path):
    d = write_release_files(str(tmp_path / "json"))
    tables, rejects = _load(spark, d, str(tmp_path / "out"))
    rej = {(r.file_name, r.reason) for r in rejects.collect()}
    assert ("bad.json", "no_releases_key") in rej
    assert ("broken.json", "malformed") in rej
    assert ("hebdo_20210301_20210307.json", "bid_related_lot_unknown") in rej
    assert ("mensuel_20210101_20210131.json", "bid_party_missing") in rej

    cur, hist = tables["releases"]
    assert rows(cur, "ocid", "release_id") == [("ocds-1", "r1b"), ("ocds-2", "r2")]
    r1 = cur.where("ocid = 'ocds-1'").first()
    assert r1.date is None and r1.tag == "contract"
    assert r1.tender_item_id == "only"                     # single item kept even with the marker
    h = hist.where("ocid = 'ocds-1'").first()
    assert h.release_id == "r1" and str(h.date) == "2021-01-05 10:00:00"   # offset dropped
    assert h.tender_item_id == "i3"                          # marker dropped, alnum class id preferred
    assert h.tender_item_additional_id == "G12"              # alnum classification preferred
    assert h.tender_duration_in_days is None and h.tender_number_of_tenderers == 3
    assert h.tender_documents == "http://a,http://b"
    assert str(h.tender_end_date) == "2021-01-20 00:00:00"

    lots, lots_h = tables["lots"]
    assert rows(lots, "lot_id", "ocid") == [("L1", "ocds-2"), ("L2", "ocds-1")]   # global lot key
    assert lots_h.count() == 1

    parties, parties_h = tables["parties"]
    p = {r.party_id: r for r in parties.collect()}
    assert p["P1"].street_address == "1 rue"
    # 1 rue -> 2 rue (appended) -> 1 rue (differs from stored 2 rue, not in list: appended)
    assert p["P1"].alias_parties == "Ville A|2 rue|Montreal|QC|H1H|Canada,Ville A|1 rue|Montreal|QC|H1H|Canada"
    assert p["P3"].name == "Fourn C" and p["P3"].street_address is None        # name-only party
    assert "P4" not in p                                                      # rejected file
    assert parties_h.where("party_id = 'P1'").count() == 2

    bids, _ = tables["bids"]
    assert rows(bids, "party_id", "related_lot", "value") == [
        ("P2", "L1", __import__("decimal").Decimal("99.50")),
        ("P2", "L2", __import__("decimal").Decimal("99.50")),
        ("P2", None, __import__("decimal").Decimal("12.25"))]
    assert {r.admissible for r in bids.collect()} == {1, None}

    awards, awards_h = tables["awards"]
    a = {r.award_id: r for r in awards.collect()}
    assert a["AX"].status == "active" and str(a["AX"].value_amount) == "70.00"
    assert [r.status for r in awards_h.collect()] == ["placeholder"]
    assert str(a["A1"].date) == "2021-01-21 00:00:00"

    sa, _ = tables["suppliers_awards"]
    assert rows(sa, "award_id", "supplier_id") == [("A1", "P2"), ("A1", "P3")]
    tx, _ = tables["contract_transactions"]
    assert rows(tx, "ocid", "transaction_id", "contract_id") == [("ocds-1", "T1", "C2")]
    rp, _ = tables["related_processes"]
    assert rp.first().relationship == "planning,parent"
    roles, _ = tables["release_parties"]
    assert ("ocds-1", "P2", "tenderer") in rows(roles, "ocid", "party_id", "role")


def test_analytics_on_loaded_tables(spark, tmp_path):
    from tenderfold.plans import analytics as A
    d = write_release_files(str(tmp_path / "json"))
    t, _ = _load(spark, d, str(tmp_path / "out"))
    cur = {k: v[0] for k, v in t.items()}
    g = A.growth_first_award(cur["contracts"], cur["awards"], cur["release_parties"], cur["parties"],
                             cur["contract_transactions"]).collect()
    by = {r.final_contract: r for r in g}
    assert len(g) == 2
    r = by[__import__("decimal").Decimal("120.00")]
    assert r.buyer_id == "P1" and str(r.initial_award) == "100.50" and str(r.additional_expenses) == "50.25"
    assert r.buyer_name == "Ville A" and str(r.growth) == "19.50"
    fb = A.growth_first_bid(cur["contracts"], cur["bids"], cur["release_parties"], cur["parties"],
                            cur["contract_transactions"]).collect()
    assert {x.supplier_id for x in fb} == {"P2"}


def test_rejection_cascades_in_file_order(spark, tmp_path):
    from tests.fixtures import write_cascade_files
    d = write_cascade_files(str(tmp_path / "cascade"))
    tables, rejects = _load(spark, d, str(tmp_path / "out"))
    rej = {(r.file_name, r.reason) for r in rejects.collect()}
    assert ("hebdo_20220101_20220107.json", "bid_related_lot_unknown") in rej
    assert ("hebdo_20220108_20220114.json", "bid_related_lot_unknown") in rej     # its lot was rolled back
    # third file: its bid's party only existed in the rejected first file -> skipped, file kept
    assert ("hebdo_20220115_20220121.json", "bid_party_missing") in rej
    assert [r.ocid for r in tables["releases"][0].collect()] == ["c3"]
    assert tables["bids"][0].count() == 0


def test_documents_round_trip(spark, tmp_path):
    """Tables -> nested documents -> reader -> fold gives the same tables."""
    from tenderfold.operators.release_fold import fold_release_events
    from tenderfold.plans.documents import release_documents
    from tenderfold.sources import release_json as RJ
    import json as _json
    from tests.fixtures import FILE_A
    d = tmp_path / "one"
    d.mkdir()
    (d / "mensuel_20210101_20210131.json").write_text(_json.dumps(FILE_A))
    tables, _ = _load(spark, str(d), str(tmp_path / "out"))
    cur = {k: v[0] for k, v in tables.items()}
    docs = release_documents(cur).checkpoint()
    files = RJ.releases_from_text(docs)
    again, rej = fold_release_events(RJ.release_events(RJ.explode_releases(files)), batch_ts="2024-01-01 00:00:00")
    assert rej.count() == 0
    checks = {"releases": ["ocid", "release_id", "date", "tag", "tender_start_date", "tender_end_date",
                           "tender_item_id", "tender_item_additional_id", "tender_documents",
                           "tender_number_of_tenderers", "tender_duration_in_days"],
              "lots": ["lot_id", "ocid", "title"], "bids": ["party_id", "ocid", "related_lot", "value", "admissible"],
              "awards": ["award_id", "ocid", "status", "value_amount", "date"],
              "suppliers_awards": ["award_id", "supplier_id", "supplier_ocid"],
              "contracts": ["contract_id", "ocid", "award_id", "value_amount", "date_signed", "period_end_date"],
              "contract_amendments": ["amendment_id", "contract_id", "rationale"],
              "contract_transactions": ["ocid", "transaction_id", "contract_id", "value_amount"],
              "related_processes": ["id", "ocid", "relationship"],
              "release_parties": ["ocid", "party_id", "role"], "parties": ["party_id", "name"]}
    for name, cols in checks.items():
        assert rows(again[name][0], *cols) == rows(cur[name], *cols), name


def test_construction_variant(spark, tmp_path):
    """Only releases with a construction item survive, with all their children."""
    import json as _json
    from tenderfold.plans.load import load_release_json, read_tables
    doc = {"releases": [
        {"ocid": "k1", "tender": {"items": [
            {"id": "x", "description": "autre", "classification": {"id": "1"}},
            {"id": "y", "description": "rien", "classification": {"id": "2"},
             "additionalClassifications": [{"scheme": "S", "id": "9", "description": "first"},
                                           {"scheme": "S", "id": "C01", "description": "C01 - Bâtiments"}]}]},
         "contracts": [{"id": "K1C", "awardID": "", "value": {"amount": 3}}]},
        {"ocid": "k2", "tender": {"items": [{"id": "z", "description": "autre"}]},
         "parties": [{"id": "PZ", "name": "Z", "roles": ["buyer"]}],
         "contracts": [{"id": "K2C", "awardID": "", "value": {"amount": 4}}]}]}
    d = tmp_path / "c"
    d.mkdir()
    (d / "mensuel_20210101_20210131.json").write_text(_json.dumps(doc, ensure_ascii=False))
    t = read_tables(spark, load_release_json(spark, str(d), str(tmp_path / "o"), construction=True))
    r = t["releases"].collect()
    assert [(x.ocid, x.tender_item_id, x.tender_item_additional_id) for x in r] == [("k1", "y", "9")]
    assert [x.contract_id for x in t["contracts"].collect()] == ["K1C"]
    assert t["parties"].count() == 0 and t["release_parties"].count() == 0
    assert [x.status for x in t["awards"].collect()] == ["placeholder"]     # empty awardID placeholder


def _fold_texts(spark, docs):
    import json as _json
    from tenderfold.operators.release_fold import fold_release_events
    from tenderfold.sources import release_json as RJ
    df = spark.createDataFrame([(n, _json.dumps({"releases": [d]})) for n, d in docs], "file_name string, value string")
    files = RJ.releases_from_text(df)
    return fold_release_events(RJ.release_events(RJ.explode_releases(files)), batch_ts="2024-01-01 00:00:00",
                               file_rejects=RJ.file_rejects(files), materialize=lambda d, _n: d.checkpoint())


def test_rejection_depends_on_committed_files_only(spark):
    party = {"id": "P9", "name": "N", "roles": ["tenderer"]}
    # A is rolled back, so B's bid has no party: it is skipped, and its unknown lot does not matter
    a = {"ocid": "a", "parties": [party], "contracts": [{"id": "CA", "awardID": "x", "value": {"amount": "abc"}}]}
    b = {"ocid": "b", "bids": [{"id": "P9", "relatedLots": ["nowhere"], "value": 1}]}
    # C has the party: its bid on an unknown lot fails; D brings a lot but fails for C's reason; E needs D's lot
    c = {"ocid": "c", "parties": [party], "bids": [{"id": "P9", "relatedLots": ["nowhere"]}]}
    d = {"ocid": "d", "tender": {"lots": [{"id": "LD"}]}, "parties": [party], "bids": [{"id": "P9", "relatedLots": ["nowhere"]}]}
    e = {"ocid": "e", "parties": [party], "bids": [{"id": "P9", "relatedLots": ["LD"]}]}
    f = {"ocid": "f", "tender": {"lots": [{"id": "LF"}]}, "parties": [party], "bids": [{"id": "P9", "relatedLots": ["LF"]}]}
    g = {"ocid": "g", "bids": [{"id": "P9", "relatedLots": ["LF"]}]}
    docs = [(f"w_2021010{i}_2021010{i}.json", x) for i, x in enumerate((a, b, c, d, e, f, g), 1)]
    tables, rejects = _fold_texts(spark, docs)
    why = {(r.file_name[9], r.reason) for r in rejects.collect()}
    assert why == {("1", "contracts_amount_not_numeric"), ("2", "bid_party_missing"), ("3", "bid_related_lot_unknown"),
                   ("4", "bid_related_lot_unknown"), ("5", "bid_related_lot_unknown")}
    assert rows(tables["releases"][0], "ocid") == [("b",), ("f",), ("g",)]


def test_repeated_lot_wide_key_and_bad_numbers(spark):
    doc = {"ocid": "x" * 300, "tender": {"lots": [{"id": "L"}], "numberOfTenderers": "many", "tenderPeriod": {"durationInDay": "2147483647"}},
           "parties": [{"id": "P", "name": " N\t", "roles": []}],
           "bids": [{"id": "P", "relatedLots": ["L", "L"], "value": 1, "admissible": "maybe"}]}
    tables, rejects = _fold_texts(spark, [("w_20210101_20210107.json", doc)])
    assert tables["bids"][0].count() == 1 and tables["bids"][1].count() == 1
    assert tables["releases"][0].first().tender_duration_in_days == 2147483647
    assert tables["parties"][0].first()["name"] == "N"
    assert {r.reason for r in rejects.collect()} == {"releases_ocid_too_long", "releases_tenderers_not_a_number",
                                                     "bids_admissible_not_a_bit"}
