"""Each operator against a brute-force version, on odd rows and on an empty table."""

import hashlib
import itertools
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import jaccard_join
from tripflow.llm.exact_dedup import drop_exact_copies, exact_groups
from tripflow.llm.jaccard_join import Similarity, connected, drop_near_copies, jaccard_components
from tripflow.llm.mixing import EPOCH, Level, about_tokens, leaf_budgets, mix_documents
from tripflow.llm.packing import difference, pack_documents, windows_for
from tripflow.llm.pii import find_personal_data
from tripflow.llm.quality import SCORE, fit_quality, train_network
from tripflow.llm.queries import vocabulary
from tripflow.llm.secrets import BASE_RULES, scan_secrets, trigram_query
from tripflow.llm.sharding import JUMP_MULTIPLIER, jump_shard, shard_documents
from tripflow.llm.shared import Tables, shared_path
from tripflow.llm.shingles import NO_COUNTS
from tripflow.llm.token_files import read_token_files, write_token_files
from tripflow.llm.tokenizing import WordMemoEncoder
from tripflow.llm.topk_search import integer_components, search_block, top_k

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"


def reference_ids(name, end_id):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary(name))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, end_id]


# --- tokens, packing, files


@pytest.mark.parametrize("name", [WORDS, BYTES])
def test_word_memo_gives_the_tokenizers_ids(name, odd_rows):
    parts = [" ", "  ", "\n", "\n\n", "\t", "\xa0", " ", "\x1c", "a", "b'", "'s", "'re", "12", ".", "##", "é", "́", "Σ", "İ", "ß", "中", "😀", "<|endoftext|>", " w", "a\nB.", "x.\ny,"]
    rng = random.Random(1)
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(4000)] + [r[1] or "" for r in odd_rows]
    own, other = WordMemoEncoder(vocabulary(name), 0, max_words=300), reference_ids(name, 0)
    for at in range(0, len(texts), 50):
        ids, n = own.encode(texts[at : at + 50])
        ends = np.cumsum(n)
        assert [ids[e - k : e].tolist() for e, k in zip(ends, n)] == [other(t) for t in texts[at : at + 50]]


def test_differencing_balances_and_adds_windows():
    rng = random.Random(3)
    sizes = [rng.randint(1, 500) for _ in range(300)]
    load = np.bincount(difference(sizes, 20), weights=sizes, minlength=20)
    assert load.sum() == sum(sizes) and load.max() - load.min() <= 20
    place = windows_for([700, 700, 700, 700], 1000)  # three windows would do by their sum, four by their sizes
    assert sorted(place) == [0, 1, 2, 3]


def test_packing_covers_every_id_once(odd, odd_rows):
    ids = reference_ids(WORDS, 1)
    want = {r[0]: np.array(ids(r[1]), "<u4") for r in odd_rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in pack_documents(odd, vocabulary(WORDS)).collect():
        assert bytes(r.ids) == want[r.doc_id][r.start : r.start + r.length].tobytes() and r.doc_tokens == len(want[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {d: sum(n for _, n in p) for d, p in pieces.items()} == {d: len(w) for d, w in want.items()}
    for parts in (*pieces.values(), *sequences.values()):
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
    assert all(sum(n for _, n in p) <= 2048 for p in sequences.values())


def test_token_files_round_trip(spark, odd, odd_rows):
    path = shared_path(spark, "test-token-files")
    write_token_files(odd, path, vocabulary(BYTES), block_bytes=4096)
    ids, start = reference_ids(BYTES, 0), 0
    got = {r.doc_id: r for r in read_token_files(spark, path).collect()}
    for row in sorted(odd_rows):
        want = np.array(ids(row[1]), "<u4")
        r = got.pop(row[0])
        assert (r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)
    assert not got
    assert {r.doc_id for r in read_token_files(spark, path, between=(10, 14)).collect()} == set(range(10, 15))


# --- copies


@pytest.mark.parametrize("least", [3, 100])
@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_groups(odd, odd_rows, keep, least):
    groups = defaultdict(list)
    for r in odd_rows:
        groups[r[1] or ""].append(r[0])
    best = max if keep == "max" else min
    want = {
        (d, best(ids), len(ids), d == best(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for d in ids
    }
    rows = exact_groups(odd, keep=keep, least=least).collect()
    assert len(rows) == len(odd_rows) and {tuple(r) for r in rows} == want
    left = drop_exact_copies(odd, keep=keep, least=least)
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(best(ids) for ids in groups.values())


@pytest.mark.parametrize("least", [1, 100])
def test_exact_groups_with_repeated_and_null_ids(spark, least):
    rows = [(1, "a")] * 3 + [(None, "a"), (None, "b"), (None, "b"), (2, None), (2, "")]
    got = exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), least=least).collect()
    kept = sorted(((r.keep_id, r.group_size) for r in got if r.kept), key=str)
    assert len(got) == 8 and kept == [(1, 4), (2, 2), (None, 2)]


def shingles(text, n):
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
    return set() if not w else {tuple(w)} if len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def components(rows, words, percent):
    sets = {r[0]: shingles(r[1], words) for r in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    owners = defaultdict(list)
    for d in sorted(sets):
        for other, both in Counter(o for s in sets[d] for o in owners[s]).items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[other]) - both):
                a, b = find(d), find(other)
                root[max(a, b)] = min(a, b)
        for s in sets[d]:
            owners[s].append(d)
    return {(d, len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("few,block", [(32, 256), (1, 3)])
@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80)])
def test_jaccard_components(odd, odd_rows, monkeypatch, words, percent, few, block):
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    got = jaccard_components(odd, Similarity(words, percent)).collect()
    assert len(got) == len(odd_rows) and {tuple(r) for r in got} == components(odd_rows, words, percent)


def test_drop_near_copies_keeps_one_of_each_group(odd, odd_rows):
    left = drop_near_copies(odd, Similarity(5, 80))
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c in components(odd_rows, 5, 80)})


def test_connected_follows_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 99)]
    got = {tuple(r) for r in connected(spark.createDataFrame(edges, "a long, b long"), Tables(spark)).collect()}
    assert got == {(i, 0) for i in range(41)} | {(i, 99) for i in (99, 100, 101)}


# --- search


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.2, 16)]) for i in range(400)]
    vectors += [(i, vectors[3][1]) for i in range(400, 600)]  # one vector held by a third
    vectors += [(600, None), (601, [1.0, None] * 8), (602, [float("nan")] * 16), (603, [float("inf")] * 16), (604, []), (650, [0.1] * 4), (700, [0.1, 0.3, 0.1, 0.2])]
    whole = {i: np.floor(256 * np.array(v)).astype(np.int64) for i, v in vectors if v and None not in v and np.isfinite(v).all()}
    want = set()
    for q in (i for i in whole if i % 50 == 0):
        scores = sorted((-int(whole[q] @ whole[i]), i) for i in whole if i != q and len(whole[i]) == len(whole[q]))
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(scores[:5], 1)}
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").select("vec_id", integer_components(F.col("embedding")).alias("whole"))
    got = top_k(df, F.col("vec_id") % 50 == 0, 5, vector_col="whole").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_search_block_breaks_ties_by_id():
    x = np.ones((9, 8), np.int64)
    i, j, score = search_block(np.array([4]), x[:1], np.arange(9)[::-1].copy(), x, 3)
    assert (8 - j).tolist() == [0, 1, 2] and score.tolist() == [8, 8, 8]


# --- spans

PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
}


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    turned = [int(c) for c in reversed(number)]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(turned)) % 10 == 0


def test_personal_data_spans(spark, odd, odd_rows):
    rng = random.Random(9)
    parts = ["a@b.c", "x.y@z-1.de", "_q@d.e", ".", "@", "1.2.3.4", "256.1.1.1", "0001.02.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-567", "+1", "é", "😀", " ", "12345", "-", "9" * 30, "DE89370400440532013000", "call "]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 14)))) for i in range(1500)] + [(2000 + r[0], r[1]) for r in odd_rows]
    rows += [(5000, "1 " * 40_000), (5001, "a" * 100_000 + "@"), (5002, "1" * 100_000), (5003, "+1(" * 30_000)]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        want = [(k, m.start(), m.end()) for k, (p, ok) in PII.items() for m in re.finditer(p, text or "") if ok(m.group())]
        assert [s[:3] for s in got[doc_id] if s[0] != "iban"] == want
    accounts = find_personal_data(spark.createDataFrame([(1, "iban DE89370400440532013000 or DE88370400440532013000")], "doc_id long, text string"))
    assert [s[:3] for s in map(tuple, accounts.first().spans) if s[0] == "iban"] == [("iban", 5, 27)]


def test_secret_spans(spark, odd_rows):
    rng = random.Random(8)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "paſſword", ":", "=", " ", "\n", '"', "'", "abc123", "x", "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "0f", "é", "+/", "."]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 14)))) for i in range(3000)] + [(5000 + r[0], r[1]) for r in odd_rows]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    keyword = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    assign = re.compile(rf"""({keyword})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for doc_id, text in rows:
        text = text or ""
        want = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        names = [r.name for r in BASE_RULES]
        assert [s for s in got[doc_id] if s[0] in names] == [(names[k], s, e) for s, k, e in sorted(want)]


def test_trigram_queries():
    assert trigram_query("[0-9a-f]{24,}") is True and trigram_query("a?b?") is True
    assert trigram_query("abcd+e") == ("and", b"abc", b"bcd")
    assert trigram_query("(foo|bar)baz") == ("or", ("and", b"bar", b"arb", b"rba", b"baz"), ("and", b"foo", b"oob", b"oba", b"baz"))
    assert trigram_query("(?i:KEY)[0-9]*") == b"key"


# --- quality, mixing, shards


def test_quality_learns_and_handles_odd_rows(spark, odd):
    rng = random.Random(2)
    good = [" ".join(rng.choices(["the", "of", "and", "sea", "land", "sun"], k=40)) for _ in range(150)]
    bad = [" ".join(w + rng.choice(["&&&", "$$$"]) for w in rng.choices(["the", "of", "x", "y"], k=40)) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(3, None), (999, 1)], "doc_id long, quality int")
    model = fit_quality(docs, labels)
    held = [r for r in model.score(docs).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 40 and np.mean([(r[SCORE] >= 0.5) == (r.doc_id < 150) for r in held]) > 0.95
    scored = model.score(odd)
    assert scored.columns == [*odd.columns, SCORE]
    assert all(0 <= r[SCORE] <= 1 for r in scored.collect())


def test_quality_without_labels_gives_a_constant():
    x = np.zeros((3, 96))
    assert np.allclose(train_network(x[:0], np.zeros(0)).score(x), 1, atol=1e-5)
    assert np.allclose(train_network(x, np.zeros(3)).score(x), 0, atol=1e-5)


def levels():
    return [
        Level("part", F.when(F.col("source") == "src0", "a").otherwise("b"), F.when(F.col("part") == "a", 1).otherwise(3)),
        Level("lang", F.col("lang"), F.when(F.col("lang") == "en", 5).otherwise(1)),
        Level("source", F.col("source"), F.lit(1)),
    ]


def fill(budget, caps, weights):
    """Water filling, one node after the other."""
    out, left, open_ = {}, budget, sorted(caps, key=lambda n: (caps[n] / weights[n], n))
    while open_:
        level = left / sum(weights[n] for n in open_)
        n = open_[0]
        if caps[n] > weights[n] * level:
            out.update({n: int(weights[n] * level) for n in open_})
            break
        out[n] = caps[n]
        left -= caps[n]
        open_ = open_[1:]
    return out


@pytest.mark.parametrize("share,epochs", [(0.4, 1), (1.5, 3), (5.0, 2)])
def test_mixture(odd, odd_rows, share, epochs):
    tokens = {r[0]: len((r[1] or "").encode()) // 4 + 1 for r in odd_rows}
    leaf = {r[0]: ("a" if r[3] == "src0" else "b", r[2] or "", r[3]) for r in odd_rows}
    supply = Counter()
    for d, path in leaf.items():
        supply[path] += tokens[d]
    cap = lambda prefix: sum(epochs * n for p, n in supply.items() if p[: len(prefix)] == prefix)
    weight = [lambda p: 1 if p[0] == "a" else 3, lambda p: 5 if p[1] == "en" else 1, lambda p: 1]
    budgets = {(): int(sum(supply.values()) * share)}
    for depth in range(3):
        below = defaultdict(set)
        for p in supply:
            below[p[:depth]].add(p[: depth + 1])
        budgets |= {k: v for parent, kids in below.items() for k, v in fill(budgets[parent], {k: cap(k) for k in kids}, {k: weight[depth](k) for k in kids}).items()}
    want, lack, following = Counter(), {}, {}
    for path, n in supply.items():
        whole, rest = divmod(budgets[path], n)
        order = sorted((hashlib.md5(f"17:{whole}:{d}".encode()).hexdigest(), d) for d, p in leaf.items() if p == path)
        used = given = 0
        for _, d in order:
            want.update({(d, e): 1 for e in range(whole)})
            used += tokens[d]
            if used <= rest:
                want[d, whole] += 1
                given = used
            elif path not in following and whole < epochs:
                following[path] = (tokens[d], d, whole)
        lack[path] = rest - given
    # what whole documents leave of the budgets pays for the next ones of siblings, then of the level above
    won = set()
    for depth in (2, 1, 0):
        for parent in {p[:depth] for p in supply}:
            pool = sum(lack[p] for p in supply if p[:depth] == parent) - sum(following[p][0] for p in won if p[:depth] == parent)
            offers = {}
            for p in sorted(following, key=lambda p: (following[p][0], p), reverse=True):
                if p[:depth] == parent and p not in won:
                    offers[p[: depth + 1]] = p  # the last one put here is the shortest
            paid = 0
            for p in sorted(offers.values(), key=lambda p: (following[p][0], p[depth])):
                paid += following[p][0]
                if paid <= pool:
                    won.add(p)
    for p in won:
        want[following[p][1], following[p][2]] += 1
    asked, got = sum(budgets[p] for p in supply), sum(tokens[d] * n for (d, _), n in want.items())
    assert got <= asked
    mixed = mix_documents(odd, levels(), share=share, max_epochs=epochs)
    assert mixed.columns == [*odd.columns, EPOCH]
    assert Counter((r.doc_id, r[EPOCH]) for r in mixed.select("doc_id", EPOCH).collect()) == want


def test_mixture_meets_its_budget(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plain = [Level("lang", F.col("lang"), F.lit(1)), Level("source", F.col("source"), F.lit(1))]
    counted = docs.withColumn("t", about_tokens(F.col("text")))
    asked = int(counted.agg(F.sum("t")).first()[0] * 0.5)
    mixed = mix_documents(counted, plain, share=0.5)
    got = {r["lang"]: r.t for r in mixed.groupBy("lang").agg(F.sum("t").alias("t")).collect()}
    assert 0.98 * asked < sum(got.values()) <= asked
    leaves = counted.groupBy(F.col("lang").alias("__mix_lang"), F.col("source").alias("__mix_source")).agg(F.sum("t").alias("supply"))
    budgets = leaf_budgets(leaves, plain, asked, 1).groupBy("__mix_lang").agg(F.sum("budget").alias("budget")).collect()
    assert len(budgets) == len(got) and all(abs(got[r[0]] - r.budget) < 0.02 * asked for r in budgets)


def jump(key, shards):
    at, to = -1, 0
    while to < shards:
        at = to
        key = (key * JUMP_MULTIPLIER + 1) % 2**64
        to = int((at + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return at


def test_jump_shards(spark):
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *(random.Random(n).randrange(-(2**62), 2**62) for n in range(300))]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for shards in (1, 2, 16, 17, 1000):
        assert [r[0] for r in df.select(jump_shard(F.col("k"), shards)).collect()] == [jump(k % 2**64, shards) for k in keys]


def test_shard_documents(odd, odd_rows):
    text = {r[0]: (r[1] or "").encode() for r in odd_rows}
    slots = defaultdict(list)
    for r in shard_documents(odd, 16).collect():
        assert (r.size, r.text_crc32) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id]))
        assert r.shard == jump(r.doc_id, 16) and r.grown_shard in (r.shard, 16) and r.grown_shard == jump(r.doc_id, 17)
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == len(odd_rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# --- empty tables and null ids


def test_empty_tables(spark, empty):
    path = shared_path(spark, "test-empty-files")
    write_token_files(empty, path, vocabulary(BYTES))
    labels = spark.createDataFrame([], "doc_id long, quality int")
    vectors = spark.createDataFrame([], "vec_id long, whole array<long>")
    for df in (
        pack_documents(empty, vocabulary(WORDS)), exact_groups(empty), drop_exact_copies(empty), top_k(vectors, F.lit(True), vector_col="whole"),
        mix_documents(empty, levels()), scan_secrets(empty), read_token_files(spark, path), find_personal_data(empty),
        fit_quality(empty, labels).score(empty), shard_documents(empty, 16), jaccard_components(empty), drop_near_copies(empty),
    ):
        assert df.collect() == []


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "same words in both of these"), (7, "same words in both of these"), (None, None)], "doc_id long, text string")
    assert {tuple(r) for r in jaccard_components(docs, Similarity(3, 90)).collect()} == {(None, 4, None), (7, 4, 7), (None, 0, None)}
    assert sorted(r.doc_tokens for r in pack_documents(docs, vocabulary(WORDS)).collect()) == [1, 7, 7]
    assert len(shard_documents(docs, 4).collect()) == len(scan_secrets(docs).collect()) == len(find_personal_data(docs).collect()) == 3
    path = shared_path(spark, "test-null-ids")
    write_token_files(docs, path, vocabulary(BYTES))
    assert sorted(r.n_tokens for r in read_token_files(spark, path).collect())[0] == 1
    assert len(drop_near_copies(docs).collect()) == 3


def test_jaccard_rows_are_dealt_once_by_slot(spark):
    """What is joined after the token prefixes: groups as brute force finds them, from one exchange of the rows by slot; and
    sets that carry the first order's prefix only."""
    how = jaccard_join.Similarity(words=3, percent=90)
    rows = [(ref, 10 + ref % 3, [ref % 4, 100 + ref]) for ref in range(60)] + [(60, 500, [0]), (61, 10, [999])]
    nodes = spark.createDataFrame(rows, "ref long, n long, prefix array<long>")
    tables = Tables(spark)
    groups = jaccard_join._groups(nodes, how, tables)
    range_of = {n: r for n, r in nodes.select("n", how.ranges(F.col("n")).alias("r")).distinct().collect()}
    want = {}
    for ref, n, prefix in rows:
        for key in itertools.product(prefix, range_of[n]):
            want.setdefault(key, set()).add((ref, n))
    want = sorted(sorted(g) for g in want.values() if len(g) > 1)
    found = {}
    for r in groups.collect():
        found.setdefault((r["slot"], r["c"], r["hub"], r["hub_n"]), set()).add((r["ref"], r["n"]))
    assert sorted(sorted(g) for g in found.values()) == want
    assert all(c == len(g) and (hub, hub_n) == min(g) for (_, c, hub, hub_n), g in found.items())
    with_pairs = {(min(a, b), max(a, b)) for g in want for (a, n), (b, m) in itertools.permutations(g, 2) if 100 * min(n, m) >= 90 * max(n, m)}
    pairs = jaccard_join._pairs(groups, how).distinct()
    assert {tuple(r) for r in pairs.collect()} == with_pairs
    groups.collect()
    assert "ReusedExchange" in groups._jdf.queryExecution().executedPlan().toString()
    sets = jaccard_join._sets(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string"), how, jaccard_join.Common(NO_COUNTS, NO_COUNTS))
    assert sets.columns == ["doc_id", "n", "key", "counts", "prefix"]
    tables.drop()


def test_jaccard_long_texts_with_a_passage_in_common_are_told_apart_by_counts(spark, monkeypatch):
    """Long texts share rare tokens by chance: class counts rule them out before their sets are made, and links stay, also
    where two sets have different numbers of classes."""
    rng, write, seen = random.Random(7), Tables.write, {}

    def words(n):
        return ["".join(rng.choices(string.ascii_lowercase, k=9)) for _ in range(n)]

    rows = []
    for i in range(0, 24, 2):
        passage = words(60)
        rows += [(i + k, " ".join(words(1500) + passage + words(1500))) for k in (0, 1)]
    for n in (510, 1020, 4090):  # one more class or twice as many for the longer one
        base = words(n)
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base + words(20))), (len(rows) + 2, " ".join(base[: n // 2]))]

    def kept(self, df, name, partition_by=None):
        seen[name] = (out := write(self, df, name, partition_by)).count()
        return out

    monkeypatch.setattr(Tables, "write", kept)
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), Similarity(5, 80)).collect()
    assert {tuple(r) for r in got} == components(rows, 5, 80)
    assert seen["pairs"] == 3 and seen["tokens"] == 6
    how = Similarity(5, 80)
    assert not how.apart(np.full(128, 100, np.int8), np.full(64, jaccard_join.COUNT_MAX, np.int8), 2 * 64 * 200)
    assert how.apart(np.full(128, 3, np.int8), np.full(64, 1, np.int8), 7 * 64)


def test_jaccard_sets_are_made_where_texts_are_read(spark):
    """Neither texts nor sets are dealt to find those of the wanted ids, and few others get through."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("some words of text"), "id").alias("text"))
    wanted = docs.filter("doc_id % 10 = 0").select(F.col("doc_id").alias("ref"), F.col("doc_id").alias("rep"), F.lit(0).cast("long").alias("mark"))
    tokens = jaccard_join._tokens(docs, wanted, Similarity(3, 90), jaccard_join.Common(NO_COUNTS, NO_COUNTS))
    ids = {r.rep for r in tokens.collect()}
    assert ids >= set(range(0, 3000, 10)) and len(ids) < 330
    plan = tokens._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_jaccard_prefix_tokens_are_dealt_once(spark, monkeypatch):
    """The rows by token and the count of each token come from one exchange."""
    write, plans = Tables.write, {}

    def kept(self, df, name, partition_by=None):
        df.collect()
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(self, df, name, partition_by)

    monkeypatch.setattr(Tables, "write", kept)
    nodes = spark.createDataFrame([(ref, 10, [ref % 4, 100 + ref]) for ref in range(60)], "ref long, n long, prefix array<long>")
    tables = Tables(spark)
    assert jaccard_join._groups(nodes, Similarity(3, 90), tables).count() == 120
    final = plans["postings"].split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("hashpartitioning(token") <= 2
    tables.drop()
