"""Fingerprints, provenance and reproducible random order."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_rank(seed: int | str, key: Column) -> Column:
    """sha256 of seed, NUL and key as hex: a random order that every run repeats."""
    return F.sha2(F.concat(F.lit(f"{seed}\0"), key.cast("string")), 256)


def input_fingerprint(*parts: Column) -> Column:
    """First 32 hex digits of the sha256 of the parts, each closed by a unit separator; null counts as empty."""
    return F.substring(F.sha2(F.concat(*(F.concat(F.coalesce(p.cast("string"), F.lit("")), F.lit("\x1f")) for p in parts)), 256), 1, 32)


def text_fingerprint(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def config_json(settings: dict) -> str:
    """Canonical JSON: sorted keys, no spaces."""
    return json.dumps(settings, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def config_fingerprint(settings: dict) -> str:
    return hashlib.sha256(config_json(settings).encode()).hexdigest()


def bundle_identity(files: dict[str, str]) -> str:
    """sha256 over names and hashes of files, in the order of names."""
    return hashlib.sha256("".join(f"{k}\0{files[k]}\n" for k in sorted(files)).encode()).hexdigest()


def provenance(column: str, inputs: list[Column], settings: dict, done: Column) -> dict[str, Column]:
    """The three provenance columns of a computed column; rows that are not done get none."""
    return {
        f"{column}_input_hash": F.when(done, input_fingerprint(*inputs)),
        f"{column}_config_hash": F.when(done, F.lit(config_fingerprint(settings))),
        f"{column}_config_json": F.when(done, F.lit(config_json(settings))),
    }


def half(seed: int | str, key: Column) -> Column:
    """0 or 1 by the last digit of a key's stable rank."""
    return F.conv(F.substring(stable_rank(seed, key), -1, 1), 16, 10).cast("int") % 2
