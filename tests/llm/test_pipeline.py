import hashlib
import zlib

import numpy as np
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from deckspark.llm.queries import tokenizer_path

from . import test_decontaminate, test_language_id, test_line_dedup, test_simhash_gray

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def text_hash(text):
    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def brute(rows, bench):
    """The stages by their brute-force versions; doc_id -> (n, digest)."""
    teach = [(lang, t) for i, t, lang in rows if lang and t and zlib.crc32(str(i).encode()) % 4 != 2]
    kept = []
    for i, t, _ in rows:
        lang, score = test_language_id.by_hand(teach, t)
        if lang != "und" and score >= 0.5:
            kept.append((i, t))
    texts = dict(test_line_dedup.by_hand([(i, text_hash(t), t) for i, t in kept]))
    kept = {i: texts[str(i)] for i, _ in kept}
    prints = {i: test_simhash_gray.slow_fingerprint(t) for i, t in kept.items()}
    group = test_simhash_gray.classes(set(prints.values()))
    first = {}
    for i in sorted(kept):
        first.setdefault(group[prints[i]], i)
    kept = {i: kept[i] for i in first.values()}
    kept = {i: t for i, t in kept.items() if all(test_decontaminate.by_hand(t, item) < 0.8 for _, item in bench)}
    library = Tokenizer.from_file(tokenizer_path())
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in kept.items()}
    return {i: (len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()) for i, x in ids.items()}


def test_as_the_brute_force_stages(spark, edge_rows, tmp_path):
    unique = {r[0]: r for r in edge_rows if r[0] is not None}
    leaks, bench = test_decontaminate.cases()
    rows = [*unique.values(), *[(100 + k, t, lang) for k, (_, t, lang) in enumerate(leaks)]]
    docs = [(i, t, lang, "s", len(t or "")) for i, t, lang in rows]
    sf = f"file://{tmp_path}"
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    want = brute(rows, bench)
    assert {i: (r.n_tokens, r.ids_sha256) for i, r in got.items()} == want and 5 < len(want) < len(rows)
    assert all(len(r.ids) == r.n_tokens for r in got.values())


def test_stages_keep_the_columns(spark, tmp_path):
    sf = f"file://{tmp_path}"
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, sf)
        assert out.columns == COLUMNS and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, sf).count() == 0
