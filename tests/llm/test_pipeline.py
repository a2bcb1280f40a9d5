"""The stages of the pipeline on messy rows, each against brute force on its own input."""

import corpus_pipeline
from test_dedup import brute as brute_copies
from test_ngram_join import brute as brute_near


def test_stages(spark, messy):
    docs = messy
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        docs = stage(spark, docs, "").cache()
        after = docs.collect()
        kept.append(len(after))
        if name == "language_id":
            assert sorted(map(str, map(tuple, after))) == sorted(str(r) for r in before if r[1] and any(c.isalpha() for c in r[1]))
        elif name == "exact_dedup":
            assert sorted(map(str, map(tuple, after))) == sorted(str(r) for r, b in zip(before, brute_copies(before)) if b[3])
        elif name == "ngram_jaccard":
            near = brute_near([r for r in before if r[0] is not None])
            assert sorted(map(str, map(tuple, after))) == sorted(str(r) for r in before if r[0] is None or near[r[0]][1] == r[0])
        else:
            assert {r.doc_id for r in after} == {r[0] for r in before}
    assert kept[0] > kept[1] > kept[2]


def test_run(spark, tmp_path, messy):
    messy.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def brute_run(rows, library):
    """What the pipeline keeps of documents that all have a language, worked out row by row."""
    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    kept = [r for r, b in zip(kept, brute_copies(kept)) if b[3]]
    near = brute_near([r for r in kept if r[0] is not None])
    pieces = []
    for i, t, *_ in (r for r in kept if r[0] is None or near[r[0]][1] == r[0]):
        n = len(library.encode(t, add_special_tokens=False).ids) + 1
        pieces += [(i, k, low, min(2048, n - low)) for k, low in enumerate(range(0, n, 2048))]
    return pieces


def test_run_against_brute_force(spark, tmp_path, messy, rows, vocabulary):
    from tokenizers import Tokenizer

    messy.write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str((r.doc_id, r.piece, r.start, r.length)) for r in out) == sorted(map(str, brute_run(rows, Tokenizer.from_file(vocabulary))))
    filled = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.setdefault(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048


def test_empty_tables_pass_every_stage(spark, tmp_path, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
