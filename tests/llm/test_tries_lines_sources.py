"""Operators 11 to 13 against brute force, on awkward rows and at tiny limits."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weekloom.llm import convtrie, divergence, linedup
from weekloom.llm.text import pieces

BLANKS = " \t\n\x0b\x0c\r"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_lines int, term string"
LICENSE = "Permission is hereby granted to all"
OTHER = "another line that stands in many places"


def awkward_documents():
    texts = [
        None, "", "\n\n", LICENSE, f"  {LICENSE.upper()}\t\nshort\n{LICENSE}", f"a\n{OTHER}\nb\n{LICENSE}\n", f"{OTHER}\r\n\x0b{OTHER}\x0c",
        "short\nshort\nshort", "Ünïcode lines keep their own É and È here\n" * 3, "ünïcode lines keep their own É and È here",
        "x" * 19, " " * 30, LICENSE + " ", f"{OTHER}\n" * 50,
    ]
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 3}", 1, 2, "t") for i, t in enumerate(texts)]
    rows += [(20, LICENSE, None, None, 1, 2, "t"), (20, LICENSE, None, None, 1, 2, "t"), (20, f"{OTHER}\nx", "en", "", 0, 0, "")]
    rows += [(None, f"{LICENSE}\nnone", "en", "s1", 1, 2, "t"), (None, f"{OTHER}\nnone", "en", "s1", 1, 2, "t")]
    rows += [(i, f"Ünïcode lines keep their own É and È here\nrow {i}", "fr", "s1", 1, 2, "t") for i in range(30, 34)]
    return rows


# 13


def line_key(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(BLANKS))


def brute_lines(rows, min_docs, min_chars):
    held = defaultdict(set)
    low = -(10**9)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= min_chars:
                held[line_key(line)].add(low if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for x in lines:
            docs = held.get(line_key(x), ())
            if len(docs) < min_docs or max(docs) == (low if doc is None else doc):
                kept.append(x)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches,fanout,min_docs,min_chars", [(6, 3, 3, 20), (1, 2, 3, 20), (9, 2, 2, 5), (4, 9, 4, 1)])
def test_line_dedup(spark, batches, fanout, min_docs, min_chars):
    rows = awkward_documents()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = linedup.drop_common_lines(docs, min_docs, min_chars, batches, fanout)
    assert got.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped", "kept_text"]
    found = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got.collect()]
    assert sorted(found, key=str) == brute_lines([(r[0], r[1]) for r in rows], min_docs, min_chars)
    assert sorted(map(str, (r["text"] for r in got.collect()))) == sorted(str(r[1]) for r in rows)


def test_line_dedup_without_rows(spark):
    docs = spark.createDataFrame([], DOCS)
    assert linedup.drop_common_lines(docs).isEmpty()
    nothing = docs.union(spark.createDataFrame([(None, None, None, None, None, None, None)], DOCS))
    assert [(r["n_lines"], r["n_dropped"], r["kept_text"]) for r in linedup.drop_common_lines(nothing).collect()] == [(1, 0, "")]


def test_runs_of_a_level_are_merged_and_known_lines_not_added_again(spark):
    rows = [(100 - i, f"{LICENSE}\nline number {i} of this table") for i in range(80)]
    docs = spark.createDataFrame(rows, "__id bigint, text string").withColumn("__text", F.xxhash64("text"))
    lines = linedup.long_lines(docs, 20).withColumn("__batch", F.floor((100 - F.col("__id")) / 10))
    runs = linedup.Runs(3, 3)
    for i in range(8):
        runs.add(lines.where(F.col("__batch") == i), 1000)
    assert [len(level) for level in runs.levels] == [2, 2]
    one = linedup.line_key(F.lit(LICENSE))
    mine = [run.where(F.col("__h1") == F.xxhash64(F.lit(0), one)).agg(F.sum("docs")).first()[0] for run in runs.all]
    assert sum(x or 0 for x in mine) == 10  # the first batch alone
    assert [tuple(r) for r in runs.common().select("lines", "last").collect()] == [(10, 100)]


# 12


def brute_audit(rows, min_docs, top):
    def terms(text):
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        return re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)

    df, tf, groups = Counter(), Counter(), set()
    for lang, source, text in ((a or "", b or "", c or "") for a, b, c in rows):
        groups.add((lang, source))
        for term, n in Counter(terms(text)).items():
            df[lang, term] += 1
            tf[lang, source, term] += n
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (l, t), n in df.items() if l == lang and n >= min_docs)
        sources = sorted(s for l, s in groups if l == lang)
        count = {s: [tf[lang, s, t] for t in kept] for s in sources}
        total = [sum(c) for c in zip(*count.values())] if kept else []

        def share(c):
            return [1 + 10**9 * (x + 5) // (sum(c) + 5 * len(kept)) for x in c]

        p, q = {s: share(c) for s, c in count.items()}, share(total)
        for s in sources:
            pair = [(sum(abs(x - y) for x, y in zip(p[s], p[o])), o) for o in sources if o != s]
            term = [(x - y, t) for x, y, t, n in zip(p[s], q, kept, count[s]) if n and x > y]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:limit]
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("min_docs,top,block,terms", [(2, 3, 512, 4096), (1, 50, 1, 4), (3, 50, 2, 1), (1000, 5, 512, 4096)])
def test_source_divergence(spark, min_docs, top, block, terms):
    rows = [(r[2], r[3], r[1]) for r in awkward_documents()]
    rows += [("en", f"s{i % 7}", f"alpha beta{'x' * (i % 5)} Ωmega {'gamma ' * (i % 3)} İstanbul_é9z") for i in range(40)]
    rows += [("en", "s1", "same text here")] * 30 + [("en", "s2", "same text here")] * 2 + [("it", "only", "uno due"), ("it", "other", "12 34")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumn("n", F.lit("x")).repartition(5)
    got = divergence.audit(docs, min_docs, top, block, terms).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, min_docs, top)


def test_source_divergence_without_rows(spark):
    docs = spark.createDataFrame([], DOCS)
    assert divergence.audit(docs).isEmpty()
    alone = spark.createDataFrame([(None, None, None)], "lang string, source string, text string")
    assert divergence.audit(alone).isEmpty()


def test_terms_of_sliced_texts():
    texts = pa.array(["Ab c1D", None, "", "é_É-z", "q" * 20000])[1:]
    found = [[t for t in row if t] for row in divergence.terms_of(texts).to_pylist()]
    assert found == [[], [], ["é", "É", "z"], ["q" * 20000]]


def test_identical_texts_are_tokenized_once(spark):
    rows = [("en", f"s{i % 3}", "one text") for i in range(31)] + [("de", "s0", "one text")]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    got = {r["lang"]: sorted(zip(r["sources"], r["copies"])) for r in divergence.collapsed(docs).collect()}
    assert divergence.collapsed(docs).count() == 2
    assert got == {"en": [("s0", 11), ("s1", 10), ("s2", 10)], "de": [("s0", 1)]}


def test_counts_of_all_sources_of_a_term_are_shuffled_once_together(spark, monkeypatch, capsys):
    texts = [("en", f"s{i}", f"alpha beta w{i}") for i in range(40)]
    docs = spark.createDataFrame(texts * 2, "lang string, source string, text string")
    plans = {}

    def explained(df, name):
        capsys.readouterr()
        df.explain()
        plans[name] = capsys.readouterr().out
        return stored(df, name)

    stored = divergence.stored
    monkeypatch.setattr(divergence, "stored", explained)
    got = divergence.audit(docs, 3)
    assert "term-counts" not in plans
    assert plans["kept-counts"].split("MapInArrow")[0].count("Exchange") == 1
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == brute_audit(texts * 2, 3, 50)
    columns = [pa.array(c) for c in (["en"] * 40, [t for _, _, t in texts], [[s] for _, s, _ in texts], [[2]] * 40)]
    rows = next(divergence._count(iter([pa.RecordBatch.from_arrays(columns, ["lang", "text", "sources", "copies"])]))).to_pylist()
    assert sorted(r["term"] for r in rows) == ["alpha", "beta", "w"]
    alpha = next(r for r in rows if r["term"] == "alpha")
    wide = pa.RecordBatch.from_arrays([pa.array(["a b", "b", "c", "dd"]), pa.array([["s"], ["s", "t", "u"], ["s"], ["s"]])], ["text", "sources"])
    assert [p.num_rows for p in pieces([wide], limit=4, times="sources")] == [1, 2, 1]
    assert alpha["docs"] == 80 and dict(zip(alpha["sources"], alpha["counts"])) == {s: 2 for _, s, _ in texts}


# 11


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        inside = [n for n in members if n[: len(node)] == node]
        kids = [n for n in inside if len(n) == len(node) + 1]
        leaves = sum(not any(m[: len(n)] == n and len(m) > len(n) for m in inside) for n in inside)
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in inside if n)
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, depth string"


def awkward_conversations():
    rows = []
    for c in range(40):
        for t in range(1 + c * 7 % 12):
            rows.append((c, t, "user" if t % 2 else None, None if t == 3 else f"turn é{t} {c % 3 if t > 2 else ''}", "x"))
    rows += [(50, None, "user", "first of all", "x"), (50, 1, "user", "then", "x"), (50, -5, None, None, "x"), (51, 0, "", "", "x")]
    rows += [(60, 7, "user", "again", "x")] * 5 + [(61, 1, "a", "bc", "x"), (62, 1, "ab", "c", "x"), (63, 1, "abc", "", "x")]
    rows += [(None, 1, "user", "lost", "x"), (200, 5, None, None, "x")]
    rows += [(c, t, "user", "same", "x") for c in range(300, 340) for t in range(25)]
    return rows


@pytest.mark.parametrize("limit,chunk", [(2_000_000, 65_536), (4, 3)])
def test_prefix_trie(spark, monkeypatch, limit, chunk):
    monkeypatch.setattr(convtrie, "CHUNK", chunk)
    monkeypatch.setattr(convtrie, "IDS", 2)
    rows = awkward_conversations()
    turns = spark.createDataFrame(rows, CONVERSATIONS).repartition(4)
    got = convtrie.trie(turns, limit, chunk)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=str) == brute_trie([r[:4] for r in rows])


def test_prefix_trie_without_rows(spark):
    assert convtrie.trie(spark.createDataFrame([], CONVERSATIONS)).isEmpty()
    lost = spark.createDataFrame([(None, 1, "user", "lost", "x")], CONVERSATIONS)
    assert convtrie.trie(lost).isEmpty()


@pytest.mark.parametrize("shape", ["chain", "star", "comb", "random"])
def test_contraction_takes_few_rounds(spark, shape):
    n = 600
    up = {
        "chain": lambda i: i - 1, "star": lambda i: 0, "comb": lambda i: i - 2 if i % 2 == 0 else i - 1,
        "random": lambda i: hash((i * 2654435761) % 97) % i,
    }[shape]
    parent = [None] + [max(0, up(i)) for i in range(1, n)]
    depth = [0] * n
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    rows = [(i, -i, p, None if p is None else -p, depth[i], i, 1) for i, p in enumerate(parent)]
    nodes = spark.createDataFrame(rows, "n1 bigint, n2 bigint, p1 bigint, p2 bigint, depth bigint, w bigint, one bigint")
    want = [(i, 1) for i in range(n)]
    for i in reversed(range(1, n)):
        p = parent[i]
        want[p] = (want[p][0] + want[i][0], want[p][1] + want[i][1])
    sizes = []
    got = convtrie.subtree_totals(nodes, ["w", "one"], sizes)
    assert sorted((r["n1"], r["w"], r["one"]) for r in got.collect()) == [(i, *w) for i, w in enumerate(want)]
    assert len(sizes) <= 20 and sizes == sorted(sizes, reverse=True)


def test_plans_of_the_contraction_do_not_grow_with_the_rounds(spark, monkeypatch, capsys):
    scans = []

    def counted(df, name):
        capsys.readouterr()
        df.explain()
        scans.append(capsys.readouterr().out.count("FileScan"))
        return stored(df, name)

    stored = convtrie.stored
    monkeypatch.setattr(convtrie, "stored", counted)
    n = 256
    rows = [(i, -i, i - 1 if i else None, 1 - i if i else None, i, 1) for i in range(n)]
    nodes = spark.createDataFrame(rows, "n1 bigint, n2 bigint, p1 bigint, p2 bigint, depth bigint, w bigint")
    sizes = []
    got = counted(convtrie.subtree_totals(nodes, ["w"], sizes), "totals")
    assert sorted((r["n1"], r["w"]) for r in got.collect()) == [(i, n - i) for i in range(n)]
    assert len(sizes) >= 6 and max(scans) <= 6
