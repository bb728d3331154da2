"""The pipeline against a plain version of each of its stages."""

import numpy as np

import corpus_pipeline
from adit.llm import mixing, preference, resemblance, simhash
from adit.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def one_of_each_group(rows):
    """Ids of the first text of each group, all pairs compared by SimHash and by signature."""
    prints = [(simhash.fingerprint(t), resemblance.signature(np.frombuffer(simhash.shingle_hashes(t), ">u8").astype(np.uint64))) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            (fp, a), (other, b) = prints[i], prints[j]
            near = bin((fp ^ other) & (1 << 64) - 1).count("1") <= simhash.RADIUS
            if near or a and b and np.count_nonzero(np.frombuffer(a, np.uint16) == np.frombuffer(b, np.uint16)) >= resemblance.AGREE:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return [i for k, (i, _) in enumerate(rows) if root[k] == k]


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        kept[name] = docs
        docs = stage(spark, docs, SF)
        if name != "encode":
            assert docs.columns == columns
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    labels = preference.training_labels(spark.read.parquet(f"{SF}/labels.parquet"))
    scores = preference.scored(kept["quality classifier"], preference.learn(kept["quality classifier"], labels))
    assert ids(kept["exact dedup"]) == ids(scores.where("score >= 0.3"))
    best = {}
    for r in kept["exact dedup"].collect():
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    assert ids(kept["near dedup"]) == sorted(best.values())
    rows = sorted((r["doc_id"], r["text"]) for r in kept["near dedup"].collect())
    assert ids(kept["mix sources"]) == one_of_each_group(rows)
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(kept["mix sources"]).collect()}
    assert ids(docs) == sorted(i for i, n in taken.items() for _ in range(n))
    assert all(r["n_tokens"] == len(r["ids"]) for r in docs.collect())


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert set(out.columns) >= {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert out.count() > 0


def test_every_operator_has_its_query():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(SQL) <= set(QUERIES)


def test_null_and_repeated_ids_keep_their_texts(spark):
    def text(k):
        return " ".join(f"word{k}x{i}" for i in range(40))

    rows = [(None, text(k), "s") for k in range(5)] + [(7, text(10), "s"), (7, text(11), "s"), (8, text(12), "s")]
    near = [(None, text(12) + " \n", "s"), (None, text(4) + " ", "s")]  # near copies of an id and of a null id
    docs = spark.createDataFrame(rows + [rows[0], rows[5]] + near, "doc_id long, text string, source string")
    clean = lambda df: sorted((str(r["doc_id"]), r["text"].strip()) for r in df.collect())
    expected = sorted((str(i), t.strip()) for i, t, _ in rows)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns and clean(kept) == expected
    assert clean(mixing.mixed_documents(kept)) == expected
    assert len(mixing.mixed_documents(docs).collect()) == len(rows + near)


def test_rows_without_an_id_draw_by_their_texts(spark):
    docs = spark.createDataFrame([(None, f"a b c d {i}", "x" if i % 2 else "y") for i in range(200)], "doc_id long, text string, source string")
    runs = [sorted(r["text"] for r in mixing.mixed_documents(d).collect()) for d in (docs, docs.repartition(3))]
    assert runs[0] == runs[1]
