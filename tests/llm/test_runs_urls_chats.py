"""Periodic runs, URL rules and conversation repair against plain versions, and odd rows."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from claimloom.llm import chat_repair, periodic_runs, queries, url_rules
from tests.llm import helpers

QUERIES = entry.queries()
EMPTY = hashlib.sha256(b"").hexdigest()


def by(rows, *names):
    return {tuple(r[n] for n in names): r.asDict() for r in rows}


# --- periodic runs ----------------------------------------------------------------------


def plain_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by comparing all words at all distances."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length < max(6, 4 * q):
                continue
            stretch = words[start : start + length]
            if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                found.append((start, length, q))
    return sorted((s, k, q) for s, k, q in found)


def plain_kept(words: list, runs: list[tuple[int, int, int]]) -> list:
    out = {i for s, k, q in runs for i in range(s + q, s + k)}
    return [w for i, w in enumerate(words) if i not in out]


def planted(doc_id: int | None, text: str | None) -> list[bytes]:
    words = (text or "").encode().split()
    if doc_id is None:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def meant_runs(doc_id, text) -> dict:
    words = planted(doc_id, text)
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return {
        "doc_id": doc_id,
        "n_runs": len(runs),
        "start": best[0],
        "length": best[1],
        "period": best[2],
        "exponent_milli": 1000 * best[1] // best[2] if runs else None,
        "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(b" ".join(plain_kept(words, runs))).hexdigest(),
    }


def made_words(rng: random.Random) -> list[str]:
    """Runs of runs: pieces of few words, repeated, with odd words in between."""
    words: list[str] = []
    for _ in range(rng.randint(1, 5)):
        piece = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.4:
            piece = piece * rng.randint(2, 6) + [rng.choice("abcd")]
        words += piece * rng.randint(1, 9) + piece[: rng.randint(0, len(piece))]
    return words


def found_runs(spark, texts: dict[str, list[str]]) -> dict[str, list[tuple]]:
    rows = [(d, " ".join(w)) for d, w in texts.items()]
    found = periodic_runs.find_runs(spark.createDataFrame(rows, "digest string, text string"))
    out: dict[str, list[tuple]] = {d: [] for d in texts}
    for r in found.collect():
        out[r["digest"]].append((r["start"], r["length"], r["period"]))
    return {d: sorted(v) for d, v in out.items()}


def test_runs_of_made_texts_against_all_distances(spark):
    rng = random.Random(11)
    texts = {str(i): made_words(rng) for i in range(400)}
    assert found_runs(spark, texts) == {d: plain_runs(w) for d, w in texts.items()}


def test_runs_over_many_tiles_and_octaves(spark):
    rng = random.Random(5)
    long = [f"w{rng.randrange(10**6)}" for _ in range(700)]
    thue = [bin(i).count("1") % 2 for i in range(64)]
    texts = {
        "one word": ["a"] * 2000,
        "two words": ["a", "b"] * 1000 + ["a"],
        "long period": ["x"] + long * 5 + long[:13] + ["y"],
        "run in a run": (["a"] * 9 + ["b"] + long[:20]) * 6,
        "few words, long period": [str(t) for t in thue] * 7,
        "neighbours": long[:16] * 4 + long[15:31] * 5 + long[30:45] * 4,
        "just under": (long[:100] * 4)[:-1],
        "just enough": long[:100] * 4,
        "no run": long,
        "": [],
    }
    assert found_runs(spark, texts) == {d: plain_runs(w) for d, w in texts.items()}


def test_tiles_grow_in_proportion_to_the_text():
    """A text of one run gives tiles of its octave only; one without repeats gives none."""
    ids = np.zeros(100_000, dtype="<i4")
    places = list(periodic_runs.tile_places(ids))
    assert {o for o, _ in places} == {0}
    assert len(places) <= len(ids) / 8
    assert not list(periodic_runs.tile_places(np.arange(100_000, dtype="<i4")))


def test_z_function_against_its_definition():
    rng = random.Random(3)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randint(1, 40))]
        meant = []
        for i in range(len(s)):
            k = 0
            while i + k < len(s) and s[k] == s[i + k]:
                k += 1
            meant.append(k)
        most = rng.randint(1, 45)
        assert periodic_runs.z_function(s, most) == meant[:most]


RUN_ROWS = [
    (1, "x a b a b a b a b a b y"),
    (1, "x a b a b a b a b a b y"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "go  go\tgo\ngo go go"),
    (5, "no run at all"),
    (None, "go go go go go go"),
    (6, "go\u00a0go go\u00a0go go\u00a0go"),
    (7, " ".join(["lorem", "ipsum", "dolor"] * 900)),
]


@pytest.mark.parametrize("clashes", [False, True])
def test_runs_odd_rows(spark, clashes):
    docs = helpers.documents(spark, RUN_ROWS, clashes)
    found = periodic_runs.collapse_runs(docs)
    assert found.columns == docs.columns
    rows = sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in found.collect()
    )
    meant = []
    for doc_id, text in RUN_ROWS:
        words = (text or "").encode().split()
        runs = plain_runs(words)
        kept = b" ".join(plain_kept(words, runs)).decode() if runs else text
        meant.append((doc_id is not None, doc_id or 0, kept or ""))
    assert rows == sorted(meant)


def test_runs_of_an_empty_table(spark):
    docs = helpers.documents(spark, [])
    assert periodic_runs.collapse_runs(docs).collect() == []


def test_planted_periods(spark):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(i % 90))) for i in range(400)]
    rows += [(None, "go on"), (5, None)]
    found = queries.with_planted_periods(helpers.documents(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in found) == sorted(
        (str(i), b" ".join(planted(i, t)).decode()) for i, t in rows
    )


@pytest.mark.skipif(not helpers.SF_DIR.exists(), reason="the driver's tables are absent")
def test_op11(spark):
    found = QUERIES["op11_periodic_runs"](spark, str(helpers.SF_DIR)).collect()
    meant = [meant_runs(r["doc_id"], r["text"]) for r in helpers.table("documents")]
    assert sorted((r.asDict() for r in found), key=str) == sorted(meant, key=str)
    assert any(r["n_runs"] for r in meant)


# --- URL rules --------------------------------------------------------------------------


def plain_url(url: str | None) -> tuple[str, str]:
    if not url or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    rest = rest[end:]
    stop = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return host, rest[:stop]


def plain_verdict(url, rules) -> tuple:
    host, path = plain_url(url)
    fitting = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if None not in (h, p, v)
        and (h == "" or host == h or host.endswith("." + h))
        and path.startswith(p)
    ]
    *_, rule, verdict = max(fitting, default=(None, "allow"))
    return host, path, rule, verdict


URLS = [
    "http://a.net/",
    "http://a.net",
    "https://NET/x",
    "http://www.Example.NET/en/1?x=/de/#y",
    "http://example.net/en",
    "http://badexample.com/de/",
    "http://m.example.com/de/2.html",
    "http://example.com.net/de/",
    "ftp://x.org/fr/a://b.net/",
    "no url",
    "",
    None,
    "://",
    "http:///de/",
    "http://?x.net/",
    "http://x.org#fr/",
    "http://\u00c4.NET/\u00e4/\n?q",
    "http://a.b.c.d.e.f.g.h.i.net/very/long/" + "x/" * 2000,
    "http://a.net/",
]


def url_pages(spark, urls, clashes=False):
    schema = "page_id long, url string, html string"
    rows = [(None if i == 3 else i, u, None) for i, u in enumerate(urls)]
    if clashes:
        schema += ", " + helpers.CLASHES + ", path string, rule string, verdict string, page string"
        rows = [r + (None,) * (len(helpers.CLASHES.split(", ")) + 4) for r in rows]
    return spark.createDataFrame(rows, schema)


def rule_table(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("clashes", [False, True])
def test_url_rules_odd_rows(spark, clashes, broadcast, monkeypatch):
    rules = [
        *queries.URL_RULES,
        *queries.URL_RULES,
        ("Example.Net", "/en/", "block"),
        ("", "/very/long/x/x", "block"),
        ("a.net", "", "allow"),
        ("h.i.net", "/v", "allow"),
        (None, "/", "block"),
        ("org", None, "block"),
        ("i.net", "/very/long/" + "x/" * 1500, "allow"),
    ]
    if not broadcast:
        monkeypatch.setattr(url_rules, "fits_broadcast", lambda *_: False)
    pages = url_pages(spark, URLS, clashes)
    found = url_rules.judge(pages, rule_table(spark, rules))
    rows = sorted(
        (str(r["page"]["page_id"]), r["host"], r["path"], r["rule"], r["verdict"])
        for r in found.collect()
    )
    low = [(h and h.lower(), p, v) for h, p, v in rules]
    meant = sorted(
        (str(None if i == 3 else i), *plain_verdict(u, low)) for i, u in enumerate(URLS)
    )
    assert rows == meant
    kept = url_rules.keep_allowed(pages, rule_table(spark, rules))
    assert kept.columns == pages.columns
    assert kept.count() == sum(m[-1] == "allow" for m in meant)


def test_url_rules_of_made_urls_against_all_rules(spark):
    rng = random.Random(12)

    def host():
        return ".".join(rng.choice(["a", "b", "cc"]) for _ in range(rng.randint(0, 4)))

    def path():
        return "".join(rng.choice(["/", "/x", "y", "/xy/"]) for _ in range(rng.randint(0, 4)))

    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(40)]
    urls = [f"h://{host()}/{path()}" for _ in range(300)]
    found = url_rules.judge(url_pages(spark, urls), rule_table(spark, rules)).collect()
    meant = [(None if i == 3 else i, *plain_verdict(u, rules)) for i, u in enumerate(urls)]
    columns = ("host", "path", "rule", "verdict")
    rows = [(r["page"]["page_id"], *(r[c] for c in columns)) for r in found]
    assert sorted(rows, key=str) == sorted(meant, key=str)


def test_url_rules_of_empty_tables(spark):
    none = url_pages(spark, [])
    assert url_rules.judge(none, rule_table(spark, queries.URL_RULES)).collect() == []
    found = url_rules.judge(url_pages(spark, URLS), rule_table(spark, [])).collect()
    assert {(r["rule"], r["verdict"]) for r in found} == {(None, "allow")}
    assert len(found) == len(URLS)


def test_url_rules_stay_in_the_jvm(spark):
    found = url_rules.judge(url_pages(spark, URLS), rule_table(spark, queries.URL_RULES))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- conversation repair ----------------------------------------------------------------


def plain_faults(rows: list[tuple[str, str]]) -> list[str | None]:
    seen, found = set(), []
    for role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        if not said:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def plain_repair(rows: list[tuple[str, str]]) -> tuple[int, str, list[str]]:
    """Cheapest edits by a search over whole edit strings, least cost and string first."""
    faults = plain_faults(rows)
    moves = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap = [(0, "", 0, "", ())]
    done = set()
    while True:
        cost, audit, at, last, said = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, list(said)
        for new in moves[last]:
            if new in "ua":
                made = {"u": "user:", "a": "assistant:"}[new]
                heapq.heappush(heap, (cost + 3, audit + "I", at, new, (*said, made)))
        if at == len(rows):
            continue
        role, text = rows[at]
        heapq.heappush(heap, (cost + 4, audit + "D", at + 1, last, said))
        if faults[at] in ("blank", "duplicate"):
            continue
        more = 3 * (faults[at] == "truncated")
        for new in moves[last]:
            if role[:1] == new:
                item = (cost + more, audit + "K", at + 1, new, (*said, f"{role}:{text}"))
                heapq.heappush(heap, item)
            if new in "ua":
                made = {"u": "user", "a": "assistant"}[new] + ":" + text
                heapq.heappush(heap, (cost + 3 + more, audit + "R", at + 1, new, (*said, made)))


def plain_report(rows: list[tuple[int | None, str, str]]) -> dict:
    said = [(r, t) for _, r, t in rows]
    faults = plain_faults(said)
    turns = [t for t, *_ in rows if t is not None]
    cost, audit, kept = plain_repair(said)
    pairs = itertools.pairwise(r[:1] for r, _ in said)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: faults.count(f) for f in chat_repair.FAULTS},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(kept).encode()).hexdigest(),
    }


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


ROLES = ["user", "assistant", "system", "tool", "unknown", "", " "]
SAID = ["Yes.", "No", "  ", "", "Why? ", "ok!", "So.\u00a0"]


def test_repair_against_the_search_over_edit_strings():
    rng = random.Random(13)
    for _ in range(3000):
        n = rng.randint(0, 9)
        rows = [(rng.choice(ROLES[: rng.choice([2, 3, 7])]), rng.choice(SAID)) for _ in range(n)]
        faults = plain_faults(rows)
        repairer = chat_repair.Repairer()
        made = []
        for (role, text), fault in zip(rows, faults, strict=True):
            made += repairer.add(chat_repair.Row(role, text, fault))
        made += repairer.end()
        cost, audit, said = plain_repair(rows)
        assert (repairer.cost, "".join(e.kind for e in made)) == (cost, audit)
        assert [f"{e.role}:{e.text}" for e in made if e.role is not None] == said


def test_plain_repair_against_all_edit_strings():
    """The search above finds the least of all edit strings of short conversations."""

    def all_edits(rows, faults, at, last, inserts):
        if at == len(rows) and last in ("", "a"):
            yield 0, ""
        for new in {"": "su", "s": "u", "u": "a", "a": "u"}[last]:
            if new in "ua" and inserts:
                for c, s in all_edits(rows, faults, at, new, inserts - 1):
                    yield c + 3, "I" + s
            if at < len(rows) and faults[at] not in ("blank", "duplicate"):
                more = 3 * (faults[at] == "truncated")
                for c, s in all_edits(rows, faults, at + 1, new, inserts):
                    if rows[at][0][:1] == new:
                        yield c + more, "K" + s
                    if new in "ua":
                        yield c + more + 3, "R" + s
        if at < len(rows):
            for c, s in all_edits(rows, faults, at + 1, last, inserts):
                yield c + 4, "D" + s

    rng = random.Random(1)
    for _ in range(150):
        n = rng.randint(0, 4)
        rows = [(rng.choice(ROLES[:4]), rng.choice(SAID)) for _ in range(n)]
        best = min(all_edits(rows, plain_faults(rows), 0, "", 4))
        assert plain_repair(rows)[:2] == best


def test_repair_keeps_little_of_a_long_conversation():
    rng = random.Random(2)
    repairer, most, edits = chat_repair.Repairer(), 0, 0
    for i in range(20_000):
        role = "ua"[i % 2] if rng.random() < 0.8 else rng.choice("uas")
        fault = rng.choice([None, None, None, "truncated", "blank"])
        edits += len(list(repairer.add(chat_repair.Row(role, f"text {i}", fault))))
        most = max(most, repairer.unresolved())
    edits += len(list(repairer.end()))
    assert edits >= 20_000
    assert most < 100


CHATS = {
    1: [(0, "user", "Hi."), *[(1, "assistant", "Hello.")] * 2, (4, "user", "x")],
    2: [(None, "system", "Be kind."), (None, None, "Odd."), (2, "user", None), (3, "user", "")],
    3: [(5, "user", "y" * 300_000 + ".")] * 3 + [(6, "assistant", "Yes!")],
    None: [(1, "user", "Why?"), (0, "system", "S."), (2, "assistant", "So.")],
    9: [(None, "bot", "B.")],
}


@pytest.mark.parametrize("clashes", [False, True])
def test_repair_odd_rows(spark, clashes):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(c, *r) for c, chat in CHATS.items() for r in chat]
    if clashes:
        schema += ", place int, edit string, repeated int, digest string, audit string, copy int"
        rows = [r + (None,) * 6 for r in rows]
    conversations = spark.createDataFrame(rows, schema)
    found = by(chat_repair.repair_report(conversations).collect(), "conv_id")
    edits = chat_repair.repair_edits(conversations).orderBy("conv_id", "place").collect()
    assert len(found) == len(CHATS)
    for conv_id, chat in CHATS.items():
        told = in_order((t, " " if r is None else r, " " if s is None else s) for t, r, s in chat)
        meant = plain_report(told)
        assert found[(conv_id,)] == {"conv_id": conv_id, **meant}
        own = [e for e in edits if e["conv_id"] == conv_id]
        assert "".join(e["edit"] for e in own) == meant["audit"]
        text = "\n".join(f"{e['role']}:{e['text']}" for e in own if e["role"] is not None)
        assert hashlib.sha256(text.encode()).hexdigest() == meant["repaired_sha256"]


def test_repair_of_an_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_repair.repair_report(none).collect() == []
    assert chat_repair.repair_edits(none).collect() == []


def damaged_rows(rows: list[dict]) -> dict:
    """Rows of each conversation after the damage, by the contract's words."""
    chats: dict = {}
    for r in rows:
        conv, turn, role, text = (r[c] for c in ("conv_id", "turn", "role", "text"))
        chat = chats.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
        role = "user" if kind == 4 else role
        chat += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: in_order(chat) for c, chat in chats.items()}


def check_damaged(spark, rows, folder):
    found = QUERIES["op13_chat_repair"](spark, str(folder)).collect()
    meant = [
        {"conv_id": c, **plain_report(chat)} for c, chat in damaged_rows(rows).items()
    ]
    assert sorted((r.asDict() for r in found), key=str) == sorted(meant, key=str)


@pytest.mark.skipif(not helpers.SF_DIR.exists(), reason="the driver's tables are absent")
def test_op13(spark):
    check_damaged(spark, helpers.table("conversations"), helpers.SF_DIR)


def test_op13_of_odd_rows(spark, tmp_path):
    """Conversations that the damage empties, and nulls in every column."""
    rng = random.Random(4)
    rows = [
        tuple(rng.choice([None, *c]) for c in (range(150), range(5), ROLES, SAID))
        for _ in range(400)
    ]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    made = [dict(zip(("conv_id", "turn", "role", "text"), r, strict=True)) for r in rows]
    assert any(not chat for chat in damaged_rows(made).values())
    check_damaged(spark, made, tmp_path)
