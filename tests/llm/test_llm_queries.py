"""The registered queries give the contracts' columns for every row; SQL and the pipeline's stages agree."""

import hashlib
import re
from collections import Counter

import compare
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import samples
import sentencepiece
from conftest import FOLDER

from restock.llm import near
from restock.llm.oracle import ORACLE
from restock.llm.queries import CATALOGUE

COLUMNS = {
    "op1_quality": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op2_exact_dedup": "doc_id:bigint keep_id:bigint group_size:bigint kept:boolean text_sha256:string",
    "op3_near_dedup": "doc_id:bigint n_shingles:bigint component_id:bigint kept:boolean",
    "op4_toxicity": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op5_sentencepiece": "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string",
    "op6_packed_ids": "doc_id:bigint start:bigint n_tokens:bigint ids_crc32:bigint",
    "op7_topk": "query_id:bigint rank:int vec_id:bigint score:bigint",
    "op8_sharding": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int",
    "op9_token_counts": "doc_id:bigint n_words:bigint n_tokens:bigint log_probability:double",
    "op10_mixing": "doc_id:bigint source:string size:bigint source_size:bigint target:double taken:bigint",
    "op11_spelling_variants": "word:string form:string root:string n:bigint n_near:bigint form_n:bigint",
    "op12_token_alignment": "doc_id:bigint n_a:bigint n_b:bigint n_groups:bigint n_links:bigint n_best:bigint count_sum:bigint groups_sha256:string",
    "op13_sequence_packing": "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint offset:bigint",
}
PER_DOCUMENT = sorted(set(COLUMNS) - {"op7_topk", "op11_spelling_variants", "op13_sequence_packing"})


def test_all_are_registered():
    import __spark_entry__

    assert set(CATALOGUE) == set(COLUMNS)
    assert set(CATALOGUE) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_every_row_has_its_result(spark, name):
    found = CATALOGUE[name](spark, FOLDER)
    assert " ".join(f"{n}:{t}" for n, t in found.dtypes) == COLUMNS[name]
    if name in PER_DOCUMENT:
        ids = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id")
        assert Counter(r.doc_id for r in found.select("doc_id").collect()) == Counter(r.doc_id for r in ids.collect())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, oracle, name):
    assert compare.spark_rows(CATALOGUE[name](spark, FOLDER)) == compare.sql_rows(oracle, ORACLE[name])


def folder(spark, tmp_path, texts, marks):
    samples.awkward(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("texts", [samples.TEXTS, []])
@pytest.mark.parametrize("name", [*sorted(CATALOGUE), "pipeline"])
def test_awkward_tables(spark, tmp_path, name, texts):
    query = CATALOGUE.get(name, corpus_pipeline.run)
    found = query(spark, folder(spark, tmp_path, texts, [(0, 1, 0), (4, 0, 1)] if texts else [])).collect()
    if name in PER_DOCUMENT:
        assert len(found) == len(texts)
    if not texts:
        assert found == []


def test_pipeline_stages(spark, tmp_path):
    """Each stage against plain Python on what the stage before it kept."""

    def written(df):
        path = f"{tmp_path}/{len(list(tmp_path.iterdir()))}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert len(steps) == 5

    good = written(steps["quality classifier"](spark, docs, FOLDER))
    scored = {r.doc_id for r in CATALOGUE["op1_quality"](spark, FOLDER).collect() if r.predicted == 1}
    kept = {r.doc_id: r for r in good.collect()}
    assert good.columns == columns and set(kept) == scored and all(before[i] == r for i, r in kept.items())

    single = written(steps["exact dedup"](spark, good, FOLDER))
    first: dict[str, int] = {}
    for i in sorted(kept):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", kept[i].text), i)
    rows = {r.doc_id: r for r in single.collect()}
    assert single.columns == columns and set(rows) == set(first.values()) and all(before[i] == r for i, r in rows.items())

    apart = written(steps["MinHash near-dedup"](spark, single, FOLDER))
    sets = {i: near.shingles(r.text, 5) for i, r in rows.items()}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    left = {r.doc_id: r for r in apart.collect()}
    assert apart.columns == columns and set(left) == set(root.values()) and all(before[i] == r for i, r in left.items())

    mixed = written(steps["mixing sources"](spark, apart, FOLDER))
    taken: Counter = Counter()
    words = {i: r.text.split() for i, r in left.items()}
    for r in mixed.collect():
        taken[r.doc_id] += len(r.text.split())
        assert not Counter(r.text.split()) - Counter(words[r.doc_id]) and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
    assert mixed.columns == columns and all(taken[i] <= 2 * len(w) for i, w in words.items())
    assert abs(sum(taken.values()) / sum(map(len, words.values())) - 1.5) < 0.05

    ids = steps["SentencePiece encoding"](spark, mixed, FOLDER)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    expected = Counter()
    for r in mixed.collect():
        e = library.encode(r.text, add_bos=True, add_eos=True)
        expected[r.doc_id, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(e).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in ids.collect()) == expected
