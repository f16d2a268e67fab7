"""Every operator against a brute-force version, on the small tables and on awkward rows."""

import hashlib
import itertools
import re
import struct
import unicodedata
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from checks.compare import connect, differences
from weekloom.llm import backoff, bpe, cascade, decontam, kdshard, langid, multiindex, queries, repeats, simhash, triecount
from weekloom.llm.components import components

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"w{i % 37}x{i % 11}" for i in range(3000))
BASE = " ".join(f"word{i}" for i in range(60))
AWKWARD = [
    (1, None, "en", "s", None),
    (2, "", "en", None, 0),
    (3, " \t\n ", None, "s", 4),
    (4, BASE, "en", "s", len(BASE)),
    (5, BASE, "en", "t", len(BASE)),
    (6, "start " + BASE.upper() + " end", "de", "s", 10),
    (7, "start " + BASE + " end", "de", "s", 10),
    (8, LONG, "fr", "s", len(LONG)),
    (9, "a a a a " * 30, "fr", "s", 240),
    (10, "12 34 -- !!", "es", "s", 11),
    (11, "Ünïcode\u00a0text ǅ ΑΣ e\u0301 'S don't <|endoftext|> 中文 \U0001f600 x", None, "s", 5),
    (12, "one two", "es", "s", 7),
    (12, "one two", "es", "s", 7),
    (None, BASE, "en", "s", 1),
    (13, "x" * 5000, "en", "s", 5000),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def documents(spark):
    return queries.table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, FOLDER).toArrow()
    assert differences(connect(FOLDER), got, queries.ORACLE[name]) is None


# 1


def brute_containment(docs, items):
    def plain(t):
        return re.sub(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ", re.sub("[A-Z]", lambda m: m.group().lower(), t)).split(" ")

    def shingles(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    out = set()
    for d, text in docs:
        w = [x for x in plain(text or "") if x]
        for i, item in items:
            q = [x for x in plain(item or "") if x]
            if q:
                n = min(5, len(q))
                want = shingles(q, n)
                shared = len(want & shingles(w, n))
                if shared >= 0.8 * len(want):
                    out.add((d, i, shared, len(want)))
    return out


def test_decontamination_of_awkward_rows(spark, awkward, empty):
    texts = [None, "", "One, TWO!", " ".join(f"word{i}" for i in range(10, 40)), "word1 word2 word3 word4 word5 word6", "--", "nothing of it at all here"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id int, text string").withColumn("doc_id", F.lit(0))
    got = decontam.contained(awkward, items)
    rows = {(r["doc_id"], r["item_id"], r["n_shared"], r["n_shingles"]) for r in got.collect()}
    assert rows == brute_containment([(r[0], r[1]) for r in AWKWARD], list(enumerate(texts)))
    assert decontam.contained(empty, items).isEmpty() and decontam.contained(awkward, items.limit(0)).isEmpty()
    kept = decontam.without_items(awkward, items)
    dirty = {r[0] for r in rows}
    assert kept.columns == awkward.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in AWKWARD if r[0] not in dirty)


def test_decontamination_of_accented_words_in_upper_case(spark, tmp_path):
    passage = "La canción del niño está aquí, señor; ΟΔΟΣ İzmir Ünïcode mañana después también Straße"
    docs = spark.createDataFrame([(1, f"x {passage.upper()} y"), (2, passage.lower()), (3, "otra cosa")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, passage), (8, "ΟΔΟΣ")], "item_id int, text string")
    con = connect(FOLDER)
    for name, rows in (("documents", docs), ("benchmark", items)):
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = queries.op1_decontamination(spark, str(tmp_path)).toArrow()
    assert got.num_rows == 2 and differences(con, got, queries.ORACLE["op1_decontamination"]) is None
    short = "Canción Mañana Ñandú Él Ésta Ó"
    docs = spark.createDataFrame([(1, short.upper()), (2, "nada")], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, short)], "item_id int, text string")
    assert [r["doc_id"] for r in decontam.contained(docs, items).collect()] == [1]
    assert [r["doc_id"] for r in decontam.without_items(docs, items).collect()] == [2]


def test_letters_are_lowered_as_in_sql():
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    con = connect(FOLDER)
    want = con.execute("SELECT lower(chr(c::INT)) FROM range(1, 1114112) t(c) WHERE NOT c BETWEEN 55296 AND 57343 ORDER BY c").fetchall()
    assert [decontam.lower(c.encode()).decode() for c in every] == [r[0] for r in want]
    assert decontam.lower(b"\xffA\xc3\x89") == b"\xffa\xc3\xa9"


def test_items_too_large_to_send_are_refused(spark, awkward, monkeypatch):
    monkeypatch.setattr(decontam, "MAX_ITEM_BYTES", 3)
    with pytest.raises(ValueError, match="bytes of items"):
        decontam.contained(awkward, spark.createDataFrame([(1, "four")], "item_id int, text string"))


# 2


def brute_removal(rows, n):
    seen, out = {}, {}
    docs = {d: words(t) for d, t in rows if d is not None}
    for d in sorted(docs):
        w = docs[d]
        gone = set()
        for i in range(len(w) - n + 1):
            if seen.setdefault(tuple(w[i : i + n]), (d, i)) != (d, i):
                gone.update(range(i, i + n))
        out[d] = len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)
    return out


@pytest.mark.parametrize(("n", "base"), [(20, 10), (20, 5), (20, 20), (8, 2)])
def test_substring_dedup(awkward, n, base):
    got = repeats.without_repeats(awkward, n, base).collect()
    want = brute_removal([(r[0], r[1]) for r in AWKWARD], n)
    assert len(got) == len(AWKWARD)
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
        else:
            assert (r["n_words"], r["n_removed"], r["kept_text"]) == want[r["doc_id"]]


def test_substring_dedup_of_rows_that_share_an_id(spark):
    copy = " ".join(f"w{i}" for i in range(30))
    rows = [(2, f"{copy} and more of it"), (2, "short text here"), (2, "short text here"), (3, f"x {copy}"), (2, f"y {copy} {copy}"), (1, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {(r["doc_id"], r["text"]): r["kept_text"] for r in repeats.without_repeats(docs, 20).collect()}
    assert repeats.without_repeats(docs, 20).count() == len(rows)
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    seen, want = {}, {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0], hashes[r[1]])):
        w, gone = text.split(), set()
        for i in range(len(w) - 19):
            if seen.setdefault(tuple(w[i : i + 20]), (doc, text, i)) != (doc, text, i):
                gone.update(range(i, i + 20))
        want[doc, text] = " ".join(x for i, x in enumerate(w) if i not in gone)
    assert got == want


def test_substring_dedup_without_rows(empty):
    assert repeats.without_repeats(empty).isEmpty()


def test_levels():
    assert repeats.levels(20, 5) == [5, 10, 20]
    with pytest.raises(ValueError):
        repeats.levels(20, 3)


# 3


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_sharding(documents, shards):
    rows = kdshard.shard(documents, shards).collect()
    sizes = np.zeros(shards)
    largest = max(r["size"] for r in rows)
    for s in range(shards):
        mine = [r for r in rows if r["shard"] == s]
        sizes[s] = sum(r["size"] for r in mine)
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
    assert len(rows) == documents.count()
    # Each cut errs by half a document at most, and errors of smaller nodes add up.
    assert np.abs(sizes - sizes.mean()).max() <= 1.5 * largest


def test_sharding_of_awkward_rows(awkward, empty):
    rows = kdshard.shard(awkward, 4, ("n_chars", "lang", "source")).collect()
    assert len(rows) == len(AWKWARD)
    want = {d: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in AWKWARD}
    assert all((r["size"], r["text_crc32"]) == want[r["doc_id"]] for r in rows)
    assert {r["shard"] for r in rows} <= set(range(4))
    assert kdshard.shard(empty, 4).isEmpty()


def test_one_value_everywhere_is_still_split_evenly(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"), F.lit("en").alias("lang"), F.lit(9).alias("n_chars"))
    counts = [r["count"] for r in kdshard.shard(docs, 8).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 2


def test_copies_of_one_row_are_divided_evenly(spark):
    same = spark.range(3000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("same text").alias("text"))
    others = spark.range(998).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("text "), F.col("id") + 1000).alias("text"))
    docs = same.union(others).select("*", F.lit("en").alias("lang"), F.length("text").cast("bigint").alias("n_chars"))
    rows = kdshard.shard(docs, 24).collect()
    assert len(rows) == 3998
    sizes = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(24)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
    for s in range(24):
        mine = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert mine == list(range(len(mine)))


def brute_tree(points, shards):
    """The k-d tree in memory: (id, tie, weight, values) -> leaf numbers from left to right."""
    span = [max(1, max(p[3][d] for p in points) - min(p[3][d] for p in points)) for d in range(len(points[0][3]))]

    def split(mine, n):
        if n == 1 or not mine:
            return [mine] + [[]] * (n - 1)
        wide = [(max(p[3][d] for p in mine) - min(p[3][d] for p in mine)) / span[d] for d in range(len(span))]
        dim = wide.index(max(wide))
        mine = sorted(mine, key=lambda p: (p[3][dim], p[1], p[0]))
        goal = sum(p[2] for p in mine) * (n // 2) / n
        left = 0
        for i, p in enumerate(mine):
            if left + p[2] >= goal:
                at = i if goal - left < left + p[2] - goal else i + 1
                return split(mine[:at], n // 2) + split(mine[at:], n - n // 2)
            left += p[2]

    return split(points, shards)


@pytest.mark.parametrize("shards", [2, 7, 24])
def test_sharding_equals_a_tree_in_memory(spark, documents, shards):
    texts = documents.select("doc_id", "text", "n_chars", "lang", F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2).alias("tie"))
    points = [
        (r["doc_id"], r["tie"], len((r["text"] or "").encode()) + 8, (r["n_chars"], int.from_bytes((r["lang"] or "").encode()[:6].ljust(6, b"\0"), "big")))
        for r in texts.collect()
    ]
    want = {p[0]: i for i, leaf in enumerate(brute_tree(points, shards)) for p in leaf}
    got = {r["doc_id"]: r["shard"] for r in kdshard.shard(documents, shards).collect()}
    assert sum(got[d] == want[d] for d in want) >= 0.99 * len(want)


# 4


def test_cascade_is_exact(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("h1"), F.xxhash64("id", F.lit(1)).alias("h2"), (F.col("id") % 7 == 0).alias("listed"))
    made = cascade.build(keys)
    rows = keys.toPandas()
    assert (made.listed(rows["h1"].to_numpy(), rows["h2"].to_numpy()) == rows["listed"]).all()
    assert len(made.levels) > 2 and made.nbytes < 20_000
    with pytest.raises(ValueError, match="bytes"):
        cascade.build(keys, max_bytes=64)


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://A.Example.COM/en/x?q#f", "https://www.example.com/en/", "https://WWW.example.com/en",
            "ftp://x.net/es/1", "x://net/fr/", "http://spam-farm.example.org", "http://a.spam-farm.example.org?x=/en/", "http://notnet/es/",
            "http://u@h.com:80/p#a://b", "http://y.org/a\nb?c"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r["page_id"]: r for r in cascade.judge(pages, queries.RULES, queries.listed_address).collect()}
    for i, url in enumerate(urls):
        rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host) :], re.S).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in queries.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        rule = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        bad = hashlib.md5((host + path).encode()).hexdigest()[0] in queries.LISTED
        want = rule[2] if rule else "block" if bad else "allow"
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule and rule[0] + rule[1], want), url
    assert cascade.judge(pages.limit(0), queries.RULES, queries.listed_address).isEmpty()
    twice = cascade.judge(pages.union(pages), queries.RULES, queries.listed_address)
    assert twice.count() == 2 * len(urls) and twice.distinct().count() == len(urls)


def test_cascade_decides_both_ways_over_several_levels(spark, monkeypatch):
    made = []
    build = cascade.build
    monkeypatch.setattr(cascade, "build", lambda *a: made.append(build(*a)) or made[-1])
    free = queries.op4_url_cascade(spark, "/root/testdata/sf0.1").where("rule IS NULL")
    counts = {r["verdict"]: r["count"] for r in free.groupBy("verdict").count().collect()}
    assert len(made[0].levels) >= 3 and counts["block"] > 50 and counts["allow"] > 500


# 5


def test_backoff_of_awkward_rows(awkward, empty):
    texts = {}
    for d, t, *_ in AWKWARD:
        texts.setdefault(d, []).append(words(t))
    every = [w for ws in texts.values() for w in ws]
    count = {}
    for w in itertools.chain(*every):
        count[w] = count.get(w, 0) + 1
    total = sum(count.values())
    seqs = texts
    one, two, holders = {}, {}, {}
    for d, ws in ((d, ws) for d, x in seqs.items() for ws in x):
        for w in ws:
            one[w] = one.get(w, 0) + 1
        for p in zip(ws, ws[1:]):
            two[p] = two.get(p, 0) + 1
            holders.setdefault(p, set()).add(d)
    for size, dense in ((5, 2), (40, 8), (65_535, 256)):  # what moves differs, the scores do not
        got = {r["doc_id"]: r for r in backoff.score(awkward, size=size, dense=dense).collect()}
        assert set(got) == set(seqs)
        for d, x in seqs.items():
            want = 0.0
            for ws in x:
                for i, w in enumerate(ws):
                    p = (ws[i - 1], w) if i else None
                    elsewhere = holders.get(p, set()) - {d}
                    want += np.log10(two[p] / one[ws[i - 1]]) if elsewhere else np.log10((0.4 if i else 1) * one[w] / total)
            assert got[d]["log_score"] == pytest.approx(want)
            assert got[d]["n_words"] == sum(map(len, x))
    assert backoff.score(empty).isEmpty()


# 6


def brute_fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    runs = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_groups(prints, threshold=4):
    up = {d: d for d in prints}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= threshold:
            p, q = sorted((root(a), root(b)))
            up[q] = p
    return {d: root(d) for d in prints}


@pytest.mark.parametrize("which", ["documents", "awkward"])
def test_simhash(request, which):
    docs = request.getfixturevalue(which)
    rows = docs.select("doc_id", "text").collect()
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in rows if r["doc_id"] is not None}
    want = brute_groups(prints)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert (r["fp"] % 2**64, r["component_id"]) == (prints[r["doc_id"]], want[r["doc_id"]])


@pytest.mark.parametrize(("threshold", "blocks", "chunk"), [(4, 3, 2048), (4, 3, 3), (4, 2, 5), (7, 3, 4)])
def test_links_of_dense_clusters(spark, threshold, blocks, chunk):
    rng = np.random.default_rng(5)
    prints = {}
    for centre in rng.integers(0, 2**63, 12):
        for _ in range(25):
            x = int(centre)
            for bit in rng.integers(0, 64, rng.integers(0, 9)):
                x ^= 1 << int(bit)
            prints[len(prints)] = x
    distinct = {}
    for d, x in prints.items():
        distinct.setdefault(x, d)
    rows = [(x - 2**64 if x >= 2**63 else x, d) for x, d in distinct.items()]
    found = simhash.links(spark.createDataFrame(rows, "fp bigint, node bigint"), threshold, blocks, chunk)
    got = {r["node"]: r["component"] for r in components(found).collect()}
    assert {d: got.get(d, d) for d in distinct.values()} == brute_groups({d: x for x, d in distinct.items()}, threshold)


@pytest.mark.parametrize("blocks", [0, 1, 5, 64])
def test_blocks_narrower_than_the_code_are_refused(spark, blocks):
    distinct = spark.createDataFrame([(0, 1), (1, 2)], "fp bigint, node bigint")
    with pytest.raises(ValueError, match="blocks"):
        simhash.links(distinct, threshold=4, blocks=blocks)


def test_every_home_is_among_the_visited_anchors():
    fp = np.random.default_rng(3).integers(0, 2**64, 3000, np.uint64)
    for blocks in (2, 3, 4):
        for first, width in simhash.cuts(blocks):
            row, anchor, home = simhash.anchors(fp, first, width, 1)
            assert set(row[anchor == home[row]].tolist()) == set(range(len(fp)))


def test_first_of_groups(awkward, empty):
    kept = simhash.first_of_groups(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted(["1", "4", "7", "8", "9", "10", "11", "12", "None", "13"]) or len(ids) == len(set(ids))
    assert "5" not in ids and "12" in ids and "None" in ids
    assert simhash.first_of_groups(empty).isEmpty() and simhash.near_duplicates(empty).isEmpty()


def test_which_row_of_one_id_stays_does_not_depend_on_the_order(spark):
    rows = [(1, f"text number {i} of the id {'x y z ' * i}", i) for i in range(12)] + [(2, "alone", 0)]
    kept = set()
    for parts in (1, 3, 7):
        docs = spark.createDataFrame(rows[::-1] if parts == 3 else rows, "doc_id bigint, text string, n int").repartition(parts)
        kept.add(tuple(sorted(map(tuple, simhash.first_of_groups(docs).collect()))))
    assert len(kept) == 1 and [r[0] for r in kept.pop()] == [1, 2]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 300), (300, 200), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 101)}, 300: 200}


# 7


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(queries.vocabulary_file("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def model():
    return bpe.Bpe(open(queries.vocabulary_file("word_bpe_49k.json"), encoding="utf-8").read())


@pytest.mark.parametrize("which", ["documents", "awkward", "empty"])
def test_bpe_equals_the_library(request, tokenizer, which):
    docs = request.getfixturevalue(which)
    texts = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    want = []
    for d, t in texts:
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    path = queries.vocabulary_file("word_bpe_49k.json")
    got = [tuple(r) for r in bpe.digests(docs, path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_every_character_is_prepared_as_in_the_library(tokenizer, model):
    step = 3000
    # Characters newer than this Python's tables are left to each side's own version of Unicode.
    points = [c for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]
    for i in range(0, len(points), step):
        text = " ".join("a" + chr(c) + "b" for c in points[i : i + step])
        if tokenizer.encode(text, add_special_tokens=False).ids != list(model.encode(text)):
            odd = [hex(c) for c in points[i : i + step] if tokenizer.encode(f"a{chr(c)}b", add_special_tokens=False).ids != list(model.encode(f"a{chr(c)}b"))]
            assert not odd, odd[:20]


def test_streaming_equals_encoding_at_once(model):
    rng = np.random.default_rng(1)
    for alphabet in (b"abcdefghijklmnopqrstuvwxyz", b"ab", b"aeinrst", b"tionh"):
        for size in (700, 3000, 9000):
            word = bytes(rng.choice(list(alphabet), size).astype(np.uint8))
            whole = model.merged([*(model.inner[b] for b in word[:-1]), model.last[word[-1]]])
            assert list(model.stream(word)) == whole
            short = model.merged([model.inner[b] for b in word[:40]])
            assert short == model._merged_long([model.inner[b] for b in word[:40]])


def test_long_pre_tokens_are_emitted_in_portions_before_their_end(model, monkeypatch):
    monkeypatch.setattr(bpe, "PORTION", 64)
    word = "tionheas" * 400
    got = list(model.portions(f"a {word} b"))
    assert len(got) > 10 and max(n for _, _, n in got) <= 64
    assert b"".join(p for p, _, _ in got) == bpe.pack(list(model.encode(f"a {word} b")))
    read = []

    class Watched(bytes):
        def __getitem__(self, at):
            if isinstance(at, slice) and at.stop is not None:
                read.append(at.stop)
            return bytes.__getitem__(self, at)

    tokens = model.stream(Watched(word.encode()))
    next(tokens)
    assert max(read) <= 2 * model.reach < len(word) / 5  # the first token came after one window


def test_decoding_gives_the_prepared_text_back(awkward, model):
    rows = bpe.encode_decode(awkward.where("doc_id IN (4, 9, 11)"), queries.vocabulary_file("word_bpe_49k.json")).collect()
    for r in rows:
        want = " ".join(str(w) if isinstance(w, str) else model.names[w] for w in model.pretokens(r["text"]))
        assert r["decoded"].replace(" ", "") == want.replace(" ", "")
        assert r["tokens"].count(" ") + 1 == len(r["ids"])


# 8


def brute_search(rows, k):
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    ids = np.array(sorted(usable))
    m = np.stack([usable[i] for i in ids])
    out = {}
    for i in ids:
        if i % 20 == 0:
            s = (m * usable[i]).sum(axis=1)
            rest = ids != i
            order = np.lexsort((ids[rest], -s[rest]))[:k]
            out[int(i)] = [(int(a), float(b)) for a, b in zip(ids[rest][order], s[rest][order])]
    return out


def recall(got, want):
    shared = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    return shared / sum(map(len, want.values()))


def found_by(rows):
    got = {}
    for r in rows.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return got


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_multi_index(spark, scale):
    table = queries.table(spark, f"/root/testdata/{scale}", "embeddings")
    want = brute_search([(r["vec_id"], r["embedding"]) for r in table.collect()], 20)
    got = found_by(queries.op8_multi_index(spark, f"/root/testdata/{scale}"))
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    assert 0.9 <= recall(got, want) < 1


def test_multi_index_of_clustered_vectors_reads_a_small_share(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(200, 32))
    rows = [(i, (centres[i % 200] + 0.15 * rng.normal(size=32)).tolist()) for i in range(6000)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want = {q: v for q, v in brute_search([r for r in rows], 20).items()}
    got = found_by(multiindex.search(table, F.col("vec_id") % 20 == 0, 20, share=0.03, tiles=5, block=100))
    assert recall(got, want) >= 0.9


def test_only_the_cells_of_the_walk_are_read(spark):
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(3000, 8))
    books = multiindex.kmeans(rows[:, :4], 32), multiindex.kmeans(rows[:, 4:], 32)
    cell = multiindex.nearest(rows[:, :4], books[0]) * 32 + multiindex.nearest(rows[:, 4:], books[1])
    sizes = np.bincount(cell, minlength=1024)
    read = [sizes[multiindex.cells_for(q, books, sizes, 600)].sum() for q in rows[:50]]
    assert min(read) >= 600 and max(read) <= 600 + sizes.max()
    tiles, parts = multiindex.tiled(np.array([3, 0, 500, 4, 90, 20, 1]), 100)
    assert parts.tolist() == [1, 1, 5, 1, 1, 1, 1] and tiles.tolist() == [0, 0, 2, 0, 0, 0, 1]


def test_multi_index_of_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(200)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.5]) for i in range(200, 400)]  # many copies: ties
    rows += [(400, None), (420, [0.0] * 6), (440, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (460, [float("nan")] * 6), (480, [float("inf")] * 6),
             (None, [1.0] * 6), (500, [1.0, 2.0]), (20, rows[20][1]), (520, [])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit(1)).repartition(5)
    usable = [(i, np.float32(v).astype(float).tolist()) for i, v in rows if v and len(v) == 6 and None not in v]
    want = brute_search(usable, 20)
    got = {}
    for r in multiindex.search(vectors, F.col("vec_id") % 20 == 0, 20, share=1.0, tiles=30, block=7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == want
    assert multiindex.search(vectors.limit(0), F.col("vec_id") % 20 == 0).isEmpty()


def test_walk_ascends():
    a, b = np.sort(np.random.default_rng(0).normal(size=(2, 9)))
    sums = [a[i] + b[j] for i, j in multiindex.walk(a, b)]
    assert len(sums) == 81 and sums == sorted(sums)


# 9


def test_language_accuracy_on_held_out_rows(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count(F.lit(1))).first()
    assert n > 200 and right > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in langid.identify(docs).collect())


def test_language_of_awkward_rows(awkward, empty):
    got = {r["doc_id"]: r for r in langid.identify(awkward).collect()}
    for d in (1, 2, 3, 10):
        assert got[d]["lang_pred"] == "und" and got[d]["score"] == 0
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in {"en", "de", "fr", "es", "und"} for r in got.values())
    assert got[11]["lang_pred"] != "und"
    assert langid.identify(empty).isEmpty()
    nothing = langid.identify(awkward.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_language_sample_is_bounded_where_one_id_holds_many_rows(spark):
    rows = [(5, f"text number {i}", "en") for i in range(3000)] + [(i, f"texte {i}", "fr") for i in range(6, 40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    # One id has one draw by id, all rows or none; by id and text about a tenth is drawn.
    share = F.lit((1 << 30) // 10)
    wide = langid.sample(docs, share, 10**6).groupBy("lang").count().collect()
    assert 200 < {r["lang"]: r["count"] for r in wide}["en"] < 400
    cut = langid.sample(docs, F.lit(1 << 30), 20)
    assert {r["lang"]: r["count"] for r in cut.groupBy("lang").count().collect()} == {"en": 20, "fr": 20}
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange
    copies = docs.limit(1).crossJoin(spark.range(500)).select("doc_id", "text", "lang")
    assert langid.sample(copies, F.lit(1 << 30), 20).count() == 20


def test_every_text_a_landmark_is_dense_kernel_ridge():
    rng = np.random.default_rng(3)
    words_of = {"aa": "abcde", "bb": "cdefgh", "cc": "ghxyz"}
    texts, labels = [], []
    for lang, letters in words_of.items():
        for _ in range(12):
            texts.append(" ".join("".join(rng.choice(list(letters), 4)) for _ in range(6)))
            labels.append(lang)

    def grams(text):
        b = text.encode()
        return {b[i : i + n] for n in (1, 2, 3) for i in range(len(b) - n + 1)}

    every = set().union(*map(grams, texts))

    def kernel(x, y):
        a, b = grams(x) & every, grams(y) & every
        return len(a & b) / (max(len(a), 1) * max(len(b), 1)) ** 0.5

    ridge, n = 0.01, len(texts)
    K = np.array([[kernel(x, y) for y in texts] for x in texts])
    names = sorted(words_of)
    y = np.array([[1.0 if lang == name else -1.0 for name in names] for lang in labels])
    H = np.eye(n) - 1 / n
    alpha = np.linalg.solve(H @ K @ H + ridge * n * np.eye(n), y - y.mean(axis=0))
    new = ["abcd edcb", "xyzg hhxy", "cdef", "qqq unseen", *texts[:3]]
    k = np.array([[kernel(x, t) for t in texts] for x in new])
    want = (k - k.mean(axis=1, keepdims=True) - K.mean(axis=0) + K.mean()) @ alpha + y.mean(axis=0)
    model = langid.fit([langid.presence(t.encode()) for t in texts], labels, landmarks=n, ridge=ridge)
    assert model.languages == names
    assert model.values([t.encode() for t in new], model.table()) == pytest.approx(want, abs=2e-3)


def test_equal_values_go_to_the_first_language(spark):
    model = langid.Model(["bb", "cc"], np.array([97], np.int32), np.zeros((1, 2)), np.array([0.5, 0.5]))
    docs = spark.createDataFrame([(1, "a text"), (2, "1234"), (3, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    assert got == {1: ("bb", 0.75), 2: ("und", 0.0), 3: ("und", 0.0)}


def test_presence_of_long_texts_in_slices(monkeypatch):
    text = bytes(np.random.default_rng(0).integers(97, 105, 5000).astype(np.uint8))
    whole = langid.presence(text)
    monkeypatch.setattr(langid, "SLICE", 64)
    assert (langid.presence(text) == whole).all()


# 10


def brute_tokens(word, scores):
    text = triecount.MARK + word
    low = min(scores.values()) - 1
    best = [(0, 0)]
    for end in range(1, len(text) + 1):
        options = [(best[end - 1][0] + low, best[end - 1][1] - 1)]
        for start in range(end):
            if text[start:end] in scores:
                options.append((best[start][0] + scores[text[start:end]], best[start][1] - 1))
        best.append(max(options))
    return -best[-1][1]


@pytest.mark.parametrize("which", ["documents", "awkward", "empty"])
def test_token_counts(request, which):
    docs = request.getfixturevalue(which)
    scores = triecount.piece_scores(queries.vocabulary_file("piece_bpe_32k.model"))
    rows = triecount.count_tokens(docs, scores).collect()
    known = {}

    def count(w):
        if w not in known:
            known[w] = brute_tokens(w, scores) if len(w) < 200 else triecount.alone(triecount.MARK + w, triecount.Pieces(scores))
        return known[w]

    assert len(rows) == docs.count()
    for r in rows:
        all_words = (r["text"] or "").encode().split()
        assert r["n_words"] == len(all_words)
        assert r["n_tokens"] == sum(map(count, all_words))


def test_long_words_run_through_the_same_recurrence():
    rng = np.random.default_rng(3)
    scores = {bytes(p): int(s) for p, s in zip((rng.integers(97, 100, rng.integers(1, 5)).astype(np.uint8) for _ in range(40)), rng.integers(-30, 0, 40))}
    model = triecount.Pieces(scores)
    some = [bytes(rng.integers(97, 101, n).astype(np.uint8)) for n in (1, 3, 10, 60, 61, 62, 63, 64, 65, 150)]
    assert triecount.counts(some, model).tolist() == [brute_tokens(w, scores) for w in some]
    assert [triecount.alone(triecount.MARK + w, model) for w in some] == [brute_tokens(w, scores) for w in some]


def test_a_pre_token_may_have_more_tokens_than_fit_beside_a_score(monkeypatch):
    monkeypatch.setattr(triecount, "SHIFT", 8)
    model = triecount.Pieces({b"y": -3, b"yy": -4})
    assert triecount.alone(triecount.MARK + b"x" * 5000, model) == 5003
    assert triecount.counts([b"x" * 5000, b"yy" * 300], model).tolist() == [5003, 303]


def test_columns_of_the_same_names_give_way(spark, awkward):
    names = ["lang_pred", "score", "n_words", "n_tokens", "kept_text", "at", "host", "rule", "fp", "component_id", "shard", "h", "key", "anchor", "draw"]
    docs = awkward.withColumns({n: F.lit("mine") for n in names})
    items = spark.createDataFrame([(1, BASE, "mine")], "item_id int, text string, doc_id string")
    path = queries.vocabulary_file("word_bpe_49k.json")
    scores = {b"a": -1, b"b": -2}
    made = [
        (decontam.without_items(docs, items), "text"), (repeats.without_repeats(docs), "kept_text"),
        (kdshard.shard(docs, 3), "shard"), (backoff.score(docs), "n_words"), (simhash.near_duplicates(docs), "fp"),
        (simhash.first_of_groups(docs), "text"), (bpe.digests(docs, path), "n_tokens"),
        (langid.identify(docs), "score"), (triecount.count_tokens(docs, scores), "n_tokens"),
        (cascade.judge(docs.withColumn("url", F.lit("http://a.b/c")), queries.RULES, queries.listed_address), "host"),
    ]
    for df, name in made:
        assert df.where(F.col(name).cast("string") == "mine").isEmpty() and not df.isEmpty()
    assert not decontam.contained(docs, items).isEmpty()
