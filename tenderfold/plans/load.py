"""Batch loads: files -> version-log events (written) -> current + history tables.

Each step writes its output as Parquet under ``out_root`` and the next step
reads it back, so lineage is cut at every stage and a lost executor only
recomputes the stage it was in. Layout::

    out_root/_events/<table>/      per-table events of this run
    out_root/_bad_files/           files rejected whole (file_name, reason)
    out_root/current/<table>/      keyed current rows
    out_root/history/<table>/      superseded versions
    out_root/rejects/              every reject row
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderfold.operators.release_fold import fold_release_events
from tenderfold.sources import release_json as RJ


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_release_json(spark: SparkSession, src: str, out_root: str, batch_ts: str | None = None,
                      construction: bool = False) -> dict[str, str]:
    """Load every release-JSON file under ``src``; return table -> path."""
    files = RJ.read_release_files(spark, src)
    # parse the (unsplittable) files once; every table's events read the staged releases
    _write(RJ.explode_releases(files), f"{out_root}/_releases")
    releases = spark.read.parquet(f"{out_root}/_releases")
    events = RJ.release_events(releases, construction=construction)
    staged = {}
    for name, ev in events.items():
        _write(ev, f"{out_root}/_events/{name}")
        staged[name] = spark.read.parquet(f"{out_root}/_events/{name}")
    _write(RJ.file_rejects(files), f"{out_root}/_file_rejects")

    def materialize(df: DataFrame, name: str) -> DataFrame:
        _write(df, f"{out_root}/{name}")
        return spark.read.parquet(f"{out_root}/{name}")

    tables, rejects = fold_release_events(staged, batch_ts=batch_ts,
                                          file_rejects=spark.read.parquet(f"{out_root}/_file_rejects"),
                                          materialize=materialize)
    paths = {}
    for name, (cur, hist) in tables.items():
        _write(cur, f"{out_root}/current/{name}")
        _write(hist, f"{out_root}/history/{name}")
        paths[name] = f"{out_root}/current/{name}"
        paths[f"{name}_history"] = f"{out_root}/history/{name}"
    _write(rejects.distinct(), f"{out_root}/rejects")
    paths["rejects"] = f"{out_root}/rejects"
    return paths


def read_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {k: spark.read.parquet(v) for k, v in paths.items()}


def load_xml_staging(spark: SparkSession, src: str, out_root: str, batch_ts: str | None = None) -> dict[str, str]:
    """Load notice/contract/expense XML files into the staging tables (+ histories)."""
    from tenderfold.operators.staging_fold import fold_staging
    from tenderfold.sources import notice_xml as NX

    ts = F.lit(batch_ts).cast("timestamp_ntz") if batch_ts else F.localtimestamp()
    files = NX.read_xml_files(spark, src)
    _write(NX.file_rejects(files), f"{out_root}/rejects")
    rejects = spark.read.parquet(f"{out_root}/rejects")
    files = files.join(rejects.select("file_name").distinct(), "file_name", "left_anti")
    _write(NX.avis_rows(files), f"{out_root}/_parsed/avis")          # parse the notices once
    n, s, l = NX.avis_events(files, ts, rows=spark.read.parquet(f"{out_root}/_parsed/avis"))
    raw = {"avis": n, "fournisseurs": s, "avis_fournisseurs": l,
           "contrats": NX.contrat_events(files, ts), "depenses": NX.depense_events(files, ts)}
    staged = {}
    for name, ev in raw.items():                     # parse the files once
        _write(ev, f"{out_root}/_events/{name}")
        staged[name] = spark.read.parquet(f"{out_root}/_events/{name}")
    out = fold_staging(staged["avis"], staged["fournisseurs"], staged["avis_fournisseurs"],
                       staged["contrats"], staged["depenses"], ts)
    paths = {"rejects": f"{out_root}/rejects"}
    for name, (cur, hist) in out.items():
        _write(cur, f"{out_root}/current/{name}")
        paths[name] = f"{out_root}/current/{name}"
        if hist is not None:
            _write(hist, f"{out_root}/history/{name}")
            paths[f"{name}_history"] = f"{out_root}/history/{name}"
    return paths


def run_migration(spark: SparkSession, policy, staging_paths: dict[str, str], out_root: str,
                  target_paths: dict[str, str] | None = None, batch_ts: str | None = None) -> dict[str, str]:
    """Migrate staging tables under ``policy``; onto ``target_paths`` when given.

    Writes ``out_root/current/<table>``, ``out_root/history/<table>`` and
    ``out_root/conflicts``; never overwrites the target it reads.
    """
    from tenderfold.operators.migrate import apply_to_target, migrate, stub_rows

    ts = F.lit(batch_ts).cast("timestamp_ntz") if batch_ts else F.localtimestamp()
    st = {k: spark.read.parquet(v) for k, v in staging_paths.items()}
    target = hist = None
    if target_paths:
        t = {k: spark.read.parquet(v) for k, v in target_paths.items()}
        target = {k: v for k, v in t.items() if not k.endswith("_history") and k != "rejects"}
        hist = {k[: -len("_history")]: v for k, v in t.items() if k.endswith("_history")}
    mig, conflicts = migrate(policy, st["avis"], st["avis_fournisseurs"], st["fournisseurs"], st["contrats"],
                             st["depenses"], existing_parties=None if target is None else target["parties"])
    paths = {}
    for name, df in mig.items():                     # stage the migration's own writes
        _write(df, f"{out_root}/_migrated/{name}")
        mig[name] = spark.read.parquet(f"{out_root}/_migrated/{name}")
    _write(conflicts, f"{out_root}/conflicts")
    paths["conflicts"] = f"{out_root}/conflicts"
    if target is None:
        releases = mig["releases"]
        if "stub_releases" in mig:
            stubs = stub_rows(mig["stub_releases"]).join(releases.select("ocid"), "ocid", "left_anti")
            releases = releases.unionByName(stubs, allowMissingColumns=True)
        _write(releases, f"{out_root}/current/releases")
        for name in mig:
            cleared = name.endswith("_history") and policy.clear_history
            if name != "party_versions" and not cleared:
                paths[name] = f"{out_root}/_migrated/{name}"
        paths["releases"] = f"{out_root}/current/releases"
        return paths
    for name, (cur, h) in apply_to_target(policy, target, mig, ts, hist).items():
        _write(cur, f"{out_root}/current/{name}")
        paths[name] = f"{out_root}/current/{name}"
        if h is not None:
            _write(h, f"{out_root}/history/{name}")
            paths[f"{name}_history"] = f"{out_root}/history/{name}"
    return paths
