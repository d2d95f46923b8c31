"""Each stage of the pipeline against a plain version on its own input."""

import corpus_pipeline as cp
import public_tokenizers
import tiktoken
from test_native import plain_dedup, plain_mix
from test_simhash import brute_components, plain_fingerprint

from ticklake.llm import quality, queries
from ticklake.llm.bpe import load_ranks

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    before = [r.asDict() for r in docs.collect()]
    model = queries.quality_model(spark, docs, SF)
    results = []
    for name, stage in cp.STAGES:
        docs = cp.store(stage(spark, docs, SF), f"test-{name}")
        results.append([r.asDict() for r in docs.collect()])
        if name != "tokens":
            assert docs.columns == names
    good, lines, distinct, mixed, tokens = results

    import numpy as np
    x = np.array([quality.features((r["text"] or "").encode()) for r in before])
    assert {r["doc_id"] for r in good} == {r["doc_id"] for r, s in zip(before, model.score(x)) if s >= quality.CUT}

    kept = plain_dedup([(r["doc_id"], r["text"]) for r in good])
    want = {k[0]: t for k, t in kept.items() if t or t == k[1]}
    assert {r["doc_id"]: r["text"] for r in lines} == want
    assert all(r["n_chars"] == len(r["text"]) for r in lines)

    ordered = sorted(lines, key=lambda r: r["doc_id"])
    roots = brute_components([plain_fingerprint(r["text"], 4) for r in ordered], 4)
    assert {r["doc_id"] for r in distinct} == {ordered[i]["doc_id"] for i, root in enumerate(roots) if i == root}

    import hashlib
    domain = lambda s: ("web", "books", "news", "code")[int(hashlib.md5((s or "").encode()).hexdigest()[0], 16) // 4]
    rows = [r | {"domain": domain(r["source"])} for r in distinct]
    chosen = plain_mix(rows, queries.MIX_LEVELS, queries.MIX_WEIGHTS, (3, 4), 1, queries.MIX_SEED)
    assert {r["doc_id"] for r in mixed} == set(chosen) and len(mixed) == len(chosen)

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(f.read()),
                                special_tokens={})
    assert {r["doc_id"]: r["ids"] for r in tokens} == {r["doc_id"]: own.encode_ordinary(r["text"]) for r in mixed}
    assert sorted(map(str, (r["doc_id"] for r in cp.run(spark, SF).collect()))) == sorted(str(r["doc_id"]) for r in mixed)


def test_empty_documents(spark, frame):
    none = frame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_odd_rows(spark, frame):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", None, None), (3, "plain words. " * 40, "en", "s", 520),
            (3, "plain words. " * 40, "en", "s", 520)]
    docs = frame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES[1:]:
        docs = stage(spark, docs, SF)
    assert {r["doc_id"] for r in docs.collect()} <= {None, 1, 2, 3}


def test_own_domain_column_passes_through(spark):
    import corpus_pipeline
    docs = spark.createDataFrame([(i, f"word {i} " * 20, "en", f"s{i % 3}", 9, "mine") for i in range(30)],
                                 "doc_id long, text string, lang string, source string, n_chars long, domain string")
    out = corpus_pipeline.mixing_stage(spark, docs, None)
    assert out.columns == docs.columns and {r.domain for r in out.select("domain").collect()} == {"mine"}
