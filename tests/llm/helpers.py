"""Small helpers of these tests."""

from __future__ import annotations

import os
import re
from pathlib import Path

import pyarrow.parquet as pq

SF_DIR = Path(os.environ.get("LLM_TEST_SF_DIR", "/root/testdata/sf0.001"))

CLASHES = (
    "digest string, keep_id long, kept string, copies int, n string, token string, part int, "
    "host string, start string, length int, row int, score string, spans int, component string"
)


def table(name: str) -> list[dict]:
    return pq.read_table(SF_DIR / f"{name}.parquet").to_pylist()


def documents(spark, rows: list[tuple], clashes: bool = False):
    """A documents table of (doc_id, text); with other columns whose names may clash."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    values = [(d, t, "en", "src0", None if t is None else len(t)) for d, t in rows]
    if clashes:
        schema += ", " + CLASHES
        values = [v + (None,) * len(CLASHES.split(", ")) for v in values]
    return spark.createDataFrame(values, schema)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- plain versions ---------------------------------------------------------------------


def normal(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def shingles(text: str | None, size: int) -> set[tuple[str, ...]]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def similar_groups(texts: dict[int, str | None], size: int, percent: int) -> dict[int, int]:
    """Smallest reachable id of each, by comparing all pairs."""
    sets = {d: shingles(t, size) for d, t in texts.items()}
    above = {d: d for d in texts}

    def root(d: int) -> int:
        while above[d] != d:
            d = above[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if not x or not y or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            common = len(x & y)
            if 100 * common >= percent * (len(x) + len(y) - common):
                low, high = sorted((root(a), root(b)))
                above[high] = low
    return {d: root(d) for d in ids}


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) of all base spans, in order."""
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            holds = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and _luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if holds:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)
