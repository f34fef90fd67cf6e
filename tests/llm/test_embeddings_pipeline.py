import os
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.llm.helpers import documents, odd_documents, sentence
from vigil.llm.common import components, written
from vigil.llm.embedding_dedup import embedding_groups, linked_pairs
from vigil.llm.registry import LLM_ORACLE, LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, key string, size int, n int"


def expected_groups(rows, threshold=0.98):
    fit = {}
    for i, (vec_id, v, label, *_) in enumerate(rows):
        if vec_id is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fit[i] = np.array(v, np.float32).astype(float)
    links = []
    for i in fit:
        for j in fit:
            if i < j and rows[i][2] == rows[j][2] and len(fit[i]) == len(fit[j]):
                a, b = (fit[k] / np.abs(fit[k]).max() for k in (i, j))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links.append((i, j))
    n = Counter(k for link in links for k in link)
    label = list(range(len(rows)))
    for _ in rows:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    smallest = {}
    for i, part in enumerate(label):
        smallest[part] = min(smallest.get(part, rows[i][0] or 0), rows[i][0] or 0)
    return Counter((r[0], n[i], smallest[label[i]] if r[0] is not None else None, r[0] is None or r[0] == smallest[label[i]]) for i, r in enumerate(rows))


@pytest.mark.parametrize("tile_rows", [7, 1024])
def test_embedding_groups_equal_brute_force(spark, tile_rows):
    random = np.random.default_rng(4)
    centres = random.normal(size=(12, 20))
    vectors = [(c + random.normal(scale=s, size=20)).tolist() for c in centres for s in (0.0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.0)]
    rows = [(i, v, i % 2, "k", 1, 1) for i, v in enumerate(vectors)]
    rows += [(200 + i, vectors[0], 0, None, None, None) for i in range(30)] + [(3, vectors[0], 0, None, None, None)]
    rows += [
        (300, None, 0, None, None, None), (301, [], 0, None, None, None), (302, [0.0] * 20, 0, None, None, None),
        (303, [float("nan")] * 20, 0, None, None, None), (304, [None] * 20, 0, None, None, None), (305, [float("inf")] * 20, 0, None, None, None),
        (306, vectors[0], None, None, None, None), (None, vectors[0], 0, None, None, None), (307, vectors[0][:10], 0, None, None, None),
        (308, [x * 1e-30 for x in vectors[0]], 0, None, None, None), (309, [-x for x in vectors[0]], 0, None, None, None),
    ]
    found = embedding_groups(spark.createDataFrame(rows, SCHEMA), tile_rows=tile_rows)
    assert Counter(map(tuple, found.collect())) == expected_groups(rows)
    assert embedding_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    assert embedding_groups(spark.createDataFrame(rows[-11:-5], SCHEMA)).where("kept AND n_links = 0").count() == 6


def test_early_stops_lose_no_pair():
    random = np.random.default_rng(6)
    x = random.normal(size=(60, 50)) + 3 * random.normal(size=(1, 50))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for threshold in (0.85, 0.9, 0.95):
        i, j = linked_pairs(x, x, threshold, step=8)
        assert set(zip(*np.nonzero(x @ x.T >= threshold))) <= set(zip(i, j))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7)]
    edges = spark.createDataFrame(chain, "a long, b long")
    vertices = spark.createDataFrame([(i,) for i in [*range(41), *range(100, 130), 500]], "v long")
    found = {r.v: r.component for r in components(edges, vertices).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {500: 500}


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    frame = LLM_QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    expected = connection.sql(f"SELECT {', '.join(columns)} FROM ({LLM_ORACLE[name]})").fetchall()
    assert Counter(map(tuple, frame.select(columns).collect())) == Counter(expected)


def test_pipeline(spark, tmp_path):
    rows = [(i, sentence(i, 40), "en", "ab"[i % 2], None) for i in range(60)]
    rows += [(100 + i, sentence(i, 40).replace(" ", "  "), "en", "a", None) for i in range(5)]
    rows += [(200 + i, sentence(i, 40) + " more", "en", "b", None) for i in range(5)]
    rows += [(300 + i, f"{sentence(i, 30)} blockhead {sentence(i, 5)} numbskull dimwit", "en", "b", None) for i in range(80)]
    docs = documents(spark, rows + [(None, "", None, None, None), (500, None, None, "a", None)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(r[0], int(r[0] >= 300)) for r in rows], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = written(stage(spark, left, str(tmp_path)), name)
        assert left.columns == docs.columns
        ids.append(Counter(r.doc_id for r in left.select("doc_id").collect()))
    toxic, exact, near, mixed = ids
    assert not [i for i in toxic if i is not None and 300 <= i < 400] and len(toxic) == 72
    assert not [i for i in exact if i is not None and i < 5]  # the longer copies stay
    assert {i for i in near if i is not None and 100 <= i < 300} == {100, 101, 102, 103, 104}
    assert set(mixed) <= set(near) and max(mixed.values()) <= 3
    packed = corpus_pipeline.STAGES[-1][1](spark, left, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == set(mixed)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == packed.count()


def test_stages_on_empty_and_odd_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for i, rows in enumerate(([], odd_documents())):
        left = documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            left = written(stage(spark, left, str(tmp_path)), name)
        assert bool(left.count()) == bool(rows)
