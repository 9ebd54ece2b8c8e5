"""The pipeline against its stages done plainly, one after the other."""

from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from haulage.llm import staging, tokens, toxicity
from tests.conftest import SF_DIR
from tests.llm import brute
from tests.llm.test_operators import DOCS, ODD


def test_stages_follow_each_other(spark, table):
    docs, columns = table("documents"), table("documents").columns
    before = docs.collect()
    # Toxicity: the same model, one text at a time.
    model = toxicity.fit(docs.select("doc_id", "text"), table("labels"))
    clean = [r for r in before if float(model.score_texts([r.text])[0]) < 0]
    kept = corpus_pipeline.STAGES[0][1](spark, docs, SF_DIR)
    assert kept.columns == columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in clean)
    # Line dedup.
    texts = brute.line_dedup([(r.source, r.text) for r in clean])
    kept = corpus_pipeline.STAGES[1][1](spark, kept, SF_DIR)
    assert kept.columns == columns
    assert {r.doc_id: r.text for r in kept.collect()} == {r.doc_id: t for r, t in zip(clean, texts)}
    # Near-dedup.
    ids = [r.doc_id for r in clean]
    least = brute.components(ids, [brute.fingerprint(t) for t in texts])
    kept = corpus_pipeline.STAGES[2][1](spark, kept, SF_DIR)
    assert kept.columns == columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least))
    # Mixing: times are checked by the operator's own test; here every row must be one of the stage's input.
    mixed = corpus_pipeline.STAGES[3][1](spark, kept, SF_DIR)
    assert mixed.columns == columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert max(times.values()) <= 2 and set(times) <= set(least)
    # Packing.
    tokenizer, text_of = Tokenizer.from_file(tokens.default_vocabulary()), dict(zip(ids, texts))
    want = Counter()
    for key, n in times.items():
        for k, (start, piece) in enumerate(brute.pieces(brute.token_ids(tokenizer, text_of[key]))):
            want[key, k, start, len(piece), brute.crc(piece)] += n
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    filled = Counter()
    for r in got:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024 and np.mean(list(filled.values())) > 1000


def test_stages_take_odd_rows(spark):
    """Nulls in any column, texts without words, long ones, repeated rows, columns with clashing names, an empty table."""
    rows = [(*r, f"r{i}", i, "s") for i, r in enumerate(ODD)] + [(13, "long " * 60_000, None, "c", None, None, None, None)]
    odd = spark.createDataFrame(rows, DOCS).repartition(3)
    for docs in (odd, odd.filter("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = docs
            docs = staging.staged(stage(spark, before, SF_DIR), "odd")
            assert docs.dtypes == odd.dtypes, name
            kept, given = [r.asDict() for r in docs.collect()], [r.asDict() for r in before.collect()]
            key = lambda r: (r["doc_id"], r["row"])
            assert {key(r) for r in kept} <= {key(r) for r in given}, name
            if name == "line dedup":
                assert Counter(map(key, kept)) == Counter(map(key, given))
            elif name == "simhash near-dedup":
                ids = [10**6 if r["doc_id"] is None else r["doc_id"] for r in given]
                least = brute.components(ids, [brute.fingerprint(r["text"]) for r in given])
                assert sorted(10**6 if r["doc_id"] is None else r["doc_id"] for r in kept) == sorted(set(least))
            elif name == "mixing sources":
                assert max(Counter(map(key, kept)).values(), default=0) <= 2
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
        assert sum(r.piece == 0 for r in pieces) == len(kept) and all(1 <= r.length <= 1024 for r in pieces)
