import re

import numpy as np

import corpus_pipeline
from tripflow.llm.queries import vocabulary
from tripflow.llm.shared import written

DIR = "/root/testdata/sf0.001"


def test_stages_pass_documents_on(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, DIR), "test-stage")
        kept = [r.doc_id for r in docs.collect()]
        assert docs.columns == columns and len(kept) == len(set(kept)) and set(kept) <= before, name
        assert kept, name
        before = set(kept)
    packed = {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, DIR).collect()}
    assert packed == before


def test_run_equals_its_stages(spark):
    assert corpus_pipeline.run(spark, DIR).count() > 0


def _shingles(text):
    words = re.findall(r"[^ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4))} if words else set()


def test_stages_equal_brute_force(spark):
    """The stages that drop or place documents, each on what the one before kept, against plain Python."""
    from tokenizers import Tokenizer

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}

    kept = written(stages["exact dedup"](spark, docs, DIR), "test-exact")
    last = {}
    for i in sorted(rows):
        last[rows[i] or ""] = i
    assert {r.doc_id for r in kept.collect()} == set(last.values())

    near = written(stages["n-gram Jaccard join"](spark, kept, DIR), "test-near")
    sets = {i: _shingles(rows[i]) for i in sorted(last.values())}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                one, two = sorted((find(a), find(b)))
                root[two] = one
    assert {r.doc_id for r in near.collect()} == {i for i in sets if find(i) == i}

    mixed = written(stages["mixing to target weights"](spark, near, DIR), "test-mixed")
    taken = [r.doc_id for r in mixed.collect()]
    size = lambda ids: sum(len((rows[i] or "").encode()) // 4 + 1 for i in ids)
    share = size(taken) / size(r.doc_id for r in near.collect())
    assert len(taken) == len(set(taken)) and corpus_pipeline.MIX_SHARE - 0.05 < share <= corpus_pipeline.MIX_SHARE

    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    pieces, filled = {}, {}
    for r in stages["packing"](spark, mixed, DIR).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i in taken:
        ids = np.frombuffer(b"".join(b for _, b in sorted(pieces.pop(i))), "<u4").tolist()
        assert ids == [*tokenizer.encode(rows[i] or "", add_special_tokens=False).ids, 1]
    assert not pieces
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
