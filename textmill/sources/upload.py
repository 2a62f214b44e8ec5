"""From items to a committed revision, and the small durable files that go with it."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions.hashing import bundle_identity
from textmill.operators import merging as mg
from textmill.operators.contracts import ContractError, check_allowed, require_keys
from textmill.operators.enrichment import table_slug
from textmill.sources.catalog import Catalog, exists, read_text, write_text
from textmill.sources.sinks import commit, replace_file, write_mirror


def write_json(spark: SparkSession, path: str, value) -> None:
    """Replaces a small JSON file in one step."""
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    write_text(spark, part, json.dumps(value, ensure_ascii=False, indent=1, sort_keys=True))
    replace_file(spark, part, path)


# the worklist of stale cells ------------------------------------------------------------------------------------------


def worklist_path(root: str, repository: str, table: str) -> str:
    return f"{root}/stale/{table_slug(repository)}__{table}"


def load_worklist(spark: SparkSession, root: str, repository: str, table: str, key: str) -> DataFrame:
    """(key, column) cells that are still to be cleared; none if there is no list. A list of another repository or table raises."""
    path = worklist_path(root, repository, table)
    if not exists(spark, f"{path}/CURRENT"):
        return spark.createDataFrame([], f"`{key}` string, column string")
    head = json.loads(read_text(spark, f"{path}/CURRENT"))
    if head.get("repository") != repository or head.get("table") != table:
        raise ContractError(f"{path} is the list of {head.get('repository')}, {head.get('table')}")
    return spark.read.schema(f"`{key}` string, column string").parquet(f"{path}/{head['file']}")


def record_stale(stale: DataFrame, root: str, repository: str, table: str, key: str, revision: str | None) -> int:
    """Adds cells (key, column) to the list, before the revision that makes them stale is committed: after it the change cannot be seen any more. Cells are a table of their own, written anew, and a small file that names it is replaced last. Returns the cells listed."""
    spark = stale.sparkSession
    path = worklist_path(root, repository, table)
    cells = load_worklist(spark, root, repository, table, key).unionByName(stale.select(F.col(key).cast("string").alias(key), "column")).distinct()
    name = f"cells-{uuid.uuid4().hex}"
    cells.write.parquet(f"{path}/{name}")
    write_json(spark, f"{path}/CURRENT", {"repository": repository, "table": table, "file": name, "before": revision})
    return spark.read.parquet(f"{path}/{name}").count()


def clear_worklist(spark: SparkSession, root: str, repository: str, table: str, key: str) -> None:
    path = worklist_path(root, repository, table)
    name = f"cells-{uuid.uuid4().hex}"
    spark.createDataFrame([], f"`{key}` string, column string").write.parquet(f"{path}/{name}")
    write_json(spark, f"{path}/CURRENT", {"repository": repository, "table": table, "file": name, "before": None})


# the pipeline -----------------------------------------------------------------------------------------------------------


def load_baseline(catalog: Catalog, table: str, key: str, *, allow_initialize: bool = False) -> DataFrame | None:
    """The stored table; None only where there is none at all and a first upload is allowed. A table that cannot be read raises: it is never taken for an empty one."""
    spark = catalog.spark
    if not exists(spark, f"{catalog.path}/CURRENT"):
        if allow_initialize:
            return None
        raise ContractError(f"{catalog.path} has no revision; a first upload must be allowed")
    at = catalog if catalog.revision else catalog.pinned()
    if table not in at.tables():
        if allow_initialize:
            return None
        raise ContractError(f"{catalog.path} has no table {table}; a first upload must be allowed")
    return require_keys(at.read(table), key, table)


@dataclass(frozen=True)
class Upload:
    """What an upload of one table needs to know."""

    table: str
    key: str
    map: Callable[[DataFrame], DataFrame]
    sources: Sequence[str] = ()
    lineage: Mapping[str, Sequence[str]] = field(default_factory=dict)
    public: str | None = None
    keep_missing: bool = False
    exclude: Sequence[str] = ()
    least_ratio: float = 0.95


def upload(items: DataFrame, spec: Upload, path: str, *, repository: str, state: str, allow_initialize: bool = False, allow_shrink: bool = False, invalidate: bool = False, failures: DataFrame | None = None, replay: bool = True) -> dict:
    """Maps items, merges them with the stored table, lists cells whose sources have changed, clears them if asked, and commits. Other tables of the revision go into the new one as they are.

    failures: cells (key, column) that could not be read; they keep their stored values. Returns a report: the revision, rows, and how many cells were found stale and how many cleared. A mapper that loses or repeats a key, and a table that shrinks too much, stop the upload before anything is written.
    """
    spark = items.sparkSession
    now = Catalog(spark, path)
    current = now.pinned() if exists(spark, f"{path}/CURRENT") else None
    fresh = require_keys(spec.map(items), spec.key, spec.table)
    n_items, n_fresh = items.count(), fresh.count()
    if n_items != n_fresh:
        raise ContractError(f"{n_items} items gave {n_fresh} rows")
    old = load_baseline(current or now, spec.table, spec.key, allow_initialize=allow_initialize)
    report = {"table": spec.table, "items": n_items, "stale": 0, "cleared": 0}
    out = fresh
    if old is not None:
        if failures is not None:
            out = mg.restore_failed(out, old, failures, spec.key, [c for c in out.columns if c in old.columns and c != spec.key])
        gone = old.join(out.select(spec.key), spec.key, "left_anti").count() if spec.keep_missing else 0
        mg.check_shrink(n_fresh, gone, old.count(), spec.least_ratio, allow_shrink)
        stale = mg.stale_cells(mg.changed_sources(out, old, spec.key, spec.sources), spec.lineage, spec.key)
        report["stale"] = stale.count()
        merged = mg.merge(out, old, spec.key, exclude=spec.exclude, keep_missing=spec.keep_missing, public=spec.public)
        if report["stale"]:
            record_stale(stale, state, repository, spec.table, spec.key, current.revision if current else None)
        if invalidate:
            cells = load_worklist(spark, state, repository, spec.table, spec.key) if replay else stale
            columns = sorted({c for cs in spec.lineage.values() for c in cs if c in merged.columns})
            report["cleared"] = cells.where(F.col("column").isin(columns)).count() if columns else 0
            merged = mg.replay_stale(merged, cells, spec.key, columns)
        out = merged
    tables = {t: current.read(t) for t in current.tables() if t != spec.table} if current else {}
    report["revision"] = commit(tables | {spec.table: out}, path, spec.key, expected=current.revision if current else None)
    if invalidate and old is not None:
        clear_worklist(spark, state, repository, spec.table, spec.key)
    report["rows"] = Catalog(spark, path, report["revision"]).read(spec.table).count()
    return report


# allowlists, mirrors, bundles -------------------------------------------------------------------------------------------


def load_allowlist(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Columns that may be published, by table."""
    found = json.loads(read_text(spark, path))
    if not isinstance(found, dict) or any(not isinstance(v, list) or any(not isinstance(c, str) for c in v) for v in found.values()):
        raise ContractError(f"{path} is no list of columns by table")
    return found


def publish(tables: Mapping[str, DataFrame], path: str, key: str, allowlist: str, *, approve: Mapping[str, Sequence[str]] | None = None) -> str:
    """Commits projections whose columns are all allowed. Newly approved columns go into the list only after the commit has been verified."""
    spark = next(iter(tables.values())).sparkSession
    allowed = load_allowlist(spark, allowlist)
    wider = {t: [*allowed.get(t, []), *(c for c in (approve or {}).get(t, ()) if c not in allowed.get(t, []))] for t in {*allowed, *(approve or {})}}
    for name, df in tables.items():
        check_allowed(df, wider.get(name, []))
    revision = commit(tables, path, key, mode="projection")
    if wider != allowed:
        write_json(spark, allowlist, wider)
    return revision


def mirror_all(catalog: Catalog, path: str, *, repository: str, fmt: str = "parquet") -> dict:
    """Every table of one revision, each with its manifest; the list of all comes last."""
    at = catalog if catalog.revision else catalog.pinned()
    done = {t: write_mirror(at.read(t), f"{path}/{t}", repository=repository, revision=at.revision, fmt=fmt) for t in at.tables()}
    summary = {"repository": repository, "revision": at.revision, "tables": {t: {"rows": m["rows"], "files": len(m["files"])} for t, m in done.items()}}
    write_json(catalog.spark, f"{path}/tables.json", summary)
    return summary


def load_input(catalog: Catalog, table: str, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table for an analysis: its key as text, none of them null, blank, or a word for null."""
    df = catalog.read(table, columns, key)
    bad = df.where(F.col(key).isNull() | F.lower(F.trim(F.col(key))).isin("", "nan", "none", "null", "<na>")).limit(1).count()
    if bad:
        raise ContractError(f"{table}: keys that stand for null")
    return df


def check_revision(catalog: Catalog) -> Catalog:
    """The catalog, if its revision is still the current one."""
    if catalog.pinned().revision != catalog.revision:
        raise ContractError(f"revision {catalog.revision} is not current any more")
    return catalog


def write_bundle(models: Mapping[str, object], settings: dict, path: str, spark: SparkSession) -> str:
    """Saves models below a folder of their own with their settings, names the bundle by the hashes of its files, and moves the pointer last. models: what has write() as Spark ML models have."""
    stage = f"{path}/bundles/{uuid.uuid4().hex}"
    for name, model in models.items():
        model.write().overwrite().save(f"{stage}/{name}")
    write_text(spark, f"{stage}/settings.json", json.dumps(settings, sort_keys=True, ensure_ascii=False))
    hashes = _hashes(spark, stage)
    identity = bundle_identity(hashes)
    write_text(spark, f"{stage}/manifest.json", json.dumps({"id": identity, "files": hashes, "settings": settings}, sort_keys=True))
    write_json(spark, f"{path}/CURRENT.json", {"id": identity, "folder": stage.rsplit("/", 1)[-1]})
    return identity


def _hashes(spark: SparkSession, folder: str) -> dict[str, str]:
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.sha2("content", 256).alias("h")).collect()
    return {r.path.split(folder.split("://")[-1].rstrip("/") + "/", 1)[-1]: r.h for r in rows if not r.path.endswith("/manifest.json")}


def load_bundle(path: str, spark: SparkSession) -> tuple[str, dict]:
    """(folder, manifest) of the current bundle; files that are not those of its identity raise."""
    head = json.loads(read_text(spark, f"{path}/CURRENT.json"))
    folder = f"{path}/bundles/{head['folder']}"
    manifest = json.loads(read_text(spark, f"{folder}/manifest.json"))
    if _hashes(spark, folder) != manifest["files"] or bundle_identity(manifest["files"]) != head["id"]:
        raise ContractError(f"{folder} is not the bundle {head['id']}")
    return folder, manifest


def check_rewrite(has_identifier: bool, repository: str) -> None:
    """History of a repository that is cited by an identifier is never rewritten."""
    if has_identifier:
        raise ContractError(f"{repository} is cited by an identifier: its history stays")
