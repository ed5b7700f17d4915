from pyspark.sql import functions as F

from tenderfold.operators import policies as P
from tenderfold.operators.migrate import migrate
from tenderfold.operators.staging_fold import fold_staging
from tenderfold.sources import notice_xml as NX
from tests.fixtures import write_xml_files


def _staging(spark, d):
    files = NX.read_xml_files(spark, d)
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    n, s, l = NX.avis_events(files, ts)
    out = fold_staging(n, s, l, NX.contrat_events(files, ts), NX.depense_events(files, ts), ts)
    return {k: v[0] for k, v in out.items()}


def test_migrate_policies(spark, tmp_path):
    st = _staging(spark, write_xml_files(str(tmp_path / "xml")))
    args = (st["avis"], st["avis_fournisseurs"], st["fournisseurs"], st["contrats"], st["depenses"])

    t, conflicts = migrate(P.CONSTRUCTION_WITH_CONTRACTS, *args)
    rel = {r.ocid: r for r in t["releases"].collect()}
    assert set(rel) == {"ocds-ec9k95-100"}                    # C01 with a contract; 200 has none
    r = rel["ocds-ec9k95-100"]
    assert r.release_id == "N-1b" and r.tender_item_id == "C01" and r.tender_number_of_tenderers == 1
    assert r.tender_procuring_entity_id == "OP-100"
    parties = {p.party_id: p for p in t["parties"].collect()}
    assert parties["FO-111"].name == "Beta incorporée"
    assert {(x.party_id, x.role) for x in t["release_parties"].collect()} == {("OP-100", "buyer"), ("FO-111", "tenderer")}
    c = t["contracts"].collect()
    assert len(c) == 1 and c[0].contract_id == "C-1" and c[0].status == "terminated"
    assert str(c[0].period_end_date) == "2021-07-01 10:00:00" and str(c[0].date_signed) == "2021-07-01 10:00:00"
    assert t["contract_transactions"].count() == 2 and conflicts.count() == 0
    assert t["awards"].count() == 0                           # the winner link was replaced

    t5, _ = migrate(P.ALL_DATA, *args)
    stubs = {(s.ocid, s.tag) for s in t5["stub_releases"].collect()}
    assert stubs == {("ocds-ec9k95-300", "contrat"), ("ocds-ec9k95-400", "depense")} or \
        ("ocds-ec9k95-300", "contrat") in stubs
    c5 = t5["contracts"].where("contract_id = 'C-1'").first()
    assert str(c5.date_signed) == "2021-07-01 10:00:00"       # no swap: signed = final publication


def test_backfill(spark, tmp_path):
    from tenderfold.operators.backfill import backfill
    files = NX.read_xml_files(spark, write_xml_files(str(tmp_path / "xml")))
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    n, s, l = NX.avis_events(files, ts)
    out = fold_staging(n, s, l, NX.contrat_events(files, ts), NX.depense_events(files, ts), ts)
    cur = {k: v[0] for k, v in out.items()}
    hist = {k: v[1] for k, v in out.items() if v[1] is not None}
    t, _ = migrate(P.CONSTRUCTION_WITH_CONTRACTS, cur["avis"], cur["avis_fournisseurs"], cur["fournisseurs"],
                   cur["contrats"], cur["depenses"])
    b = backfill(t["releases"], cur, hist, ts, with_parties=True)
    rh = b["releases_history"].collect()
    assert [(r.ocid, r.release_id, r.tag, r.tender_procuring_entity_id) for r in rh] == \
        [("ocds-ec9k95-100", "N-1", "avis_history", "OP-100")]
    assert rh[0].tender_procurement_method == "open" and rh[0].tender_item_id == "C01"
    ch = b["contracts_history"].collect()
    assert [(r.contract_id, str(r.value_amount), r.status) for r in ch] == [("C-1", "120.00", "active")]
    bh = b["bids_history"].collect()
    assert [(r.party_id, r.value_unit, r.admissible) for r in bh] == [("FO-111", "CAD", 0)]
    ph = b["parties_history"].collect()
    assert [(r.party_id, r.name) for r in ph] == [("FO-111", "Beta inc")]


def test_migration_onto_json_target(spark, tmp_path):
    import json
    from tenderfold.plans.load import load_release_json, load_xml_staging, read_tables, run_migration
    jdir = tmp_path / "json"
    jdir.mkdir()
    doc = {"releases": [{
        "ocid": "ocds-ec9k95-100", "id": "j1",
        "tender": {"procurementMethodRationale": "because", "lots": [{"id": "L1"}, {"id": "L2"}]},
        "parties": [{"id": "P1", "name": "Ville A", "roles": ["buyer"]},
                    {"id": "FO-111", "name": "Beta incorporée", "roles": ["tenderer"]}],
        "bids": [{"id": "FO-111", "relatedLots": ["L1", "L2"], "value": 5}],
        "contracts": [{"id": "C-1", "awardID": "A9", "value": {"amount": 1, "currency": "CAD"}}]}]}
    (jdir / "mensuel_20200101_20200131.json").write_text(json.dumps(doc))
    target = load_release_json(spark, str(jdir), str(tmp_path / "out"), batch_ts="2024-01-01 00:00:00")
    staging = load_xml_staging(spark, write_xml_files(str(tmp_path / "xml")), str(tmp_path / "stg"),
                               batch_ts="2024-01-15 00:00:00")
    for policy in (P.RELATED_ONLY, P.CONSTRUCTION_WITH_CONTRACTS):
        out = read_tables(spark, run_migration(spark, policy, staging, str(tmp_path / f"mig_{policy.name}"),
                                               target_paths=target, batch_ts="2024-02-01 00:00:00"))
        rel = out["releases"].where("ocid = 'ocds-ec9k95-100'").first()
        assert rel.release_id == "N-1b" and rel.tender_procurement_method_rationale == "because"
        assert rel.tender_procuring_entity_id == "P1"                      # existing name keeps its id
        c = out["contracts"].where("contract_id = 'C-1'").first()
        assert c.award_id == "A9" and c.value_currency == "CAD" and str(c.value_amount) == "130.00"
        b = sorted((r.related_lot, str(r.value)) for r in out["bids"].where("party_id = 'FO-111'").collect())
        assert b == [("L1", "0.00"), ("L2", "0.00")]                      # every lot row updated
        rh = out["releases_history"]
        if policy.clear_history:
            assert rh.count() == 0
        else:
            assert sorted(r.release_id for r in rh.where("ocid = 'ocds-ec9k95-100'").collect()) == ["N-1b", "j1"]
            assert out["contracts_history"].where("contract_id = 'C-1'").count() == 1
