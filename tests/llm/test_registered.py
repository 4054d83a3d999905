"""The registered queries: those with SQL against it, the mix against plain Python, the rest by their contracts."""

import bisect
import collections
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from skyloom.llm import mixing
from skyloom.llm.queries import ORACLE_SQL, QUERIES
from tests.test_queries import TABLES, same


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, con, name):
    same(QUERIES[name](spark, sf_dir), con.sql(ORACLE_SQL[name]))


#: Columns that the contracts fix; more may follow.
COLUMNS = {
    "op1_html_text": "page_id url text n_chars", "op2_line_dedup": "doc_id n_lines n_dropped kept_sha256", "op3_token_files": "doc_id start n_tokens ids_crc32",
    "op4_substring": "doc_id n_words n_removed kept_sha256", "op5_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op7_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "op8_minhash": "doc_id n_shingles component_id kept",
    "op9_exact_dedup": "doc_id keep_id group_size kept text_sha256", "op10_mixing": "doc_id size source_size target taken",
    "op11_embedding_dedup": "vec_id n_links component_id kept", "op12_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13_whitening": "vec_id component n deviation whitened explained identity_error"}


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(ORACLE_SQL)))
def test_query_columns_and_rows(spark, sf_dir, name):
    out = QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[name].split()) <= set(out.columns)
    table, key, times = ("pages", "page_id", 1) if name == "op1_html_text" else ("embeddings", "vec_id", 4) if name == "op13_whitening" else ("documents", "doc_id", 1)
    ids = collections.Counter(r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key).collect() for _ in range(times))
    assert collections.Counter(r[0] for r in out.select(key).collect()) == ids


def plain_mix(rows, hashes):
    """(id, place, position) of the copies, from the definition: schedules integrated and inverted numerically."""
    by = collections.defaultdict(list)
    for k, (i, t, s) in enumerate(rows):
        by[s].append((k, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))))
    names = sorted(x for x in by if x is not None) + [None] * (None in by)
    size = {s: sum(n for _, n in by[s]) for s in names}
    weight, slope = ({s: v[k % 3] for k, s in enumerate(names)} for v in ((5, 2, 1), (-0.6, 0.0, 0.6)))
    left, target, free = 1.5 * sum(size.values()), {}, list(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * size[s]]
        for s in over or free:
            target[s] = 2.0 * size[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        free = [s for s in free if s not in target]
    grid = [k / 20000 for k in range(20001)]
    copies = []
    for s in names:
        demand = [0.0]
        for a, b in zip(grid, grid[1:], strict=False):  # the weight at the middle of each step
            demand.append(demand[-1] + (1 + slope[s] * (a + b - 1)) * (b - a) * target[s])
        at = 0
        for k, n in sorted(by[s], key=lambda r: (hashes[r[0]], rows[r[0]][0], r[1])):
            for e in range(2):
                start = at + e * size[s]
                if start + n / 2 < target[s]:
                    j = min(max(bisect.bisect_left(demand, start), 1), len(grid) - 1)
                    d = demand[j] - demand[j - 1]
                    copies.append((grid[j - 1] + (grid[j] - grid[j - 1]) * ((start - demand[j - 1]) / d if d else 0), hashes[k], rows[k][0]))
            at += n
    return copies, target, size


def test_places_and_order_of_the_mix(spark):
    """Every copy has one place; places follow the positions that inverted demand gives, and ``mix`` comes in their order."""
    rows = [(i, " ".join(["w"] * (1 + (i * 37) % 90)), f"s{i % 4}" if i % 9 else None) for i in range(240)] + [(500, None, "s1"), (501, "", "s2"), (502, "long " * 3000, "s3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    hashes = [r.h for r in spark.createDataFrame(list(enumerate((i, t or "") for i, t, _ in rows)), "k int, r struct<i:long,t:string>").orderBy("k").select(
        F.xxhash64(F.lit(17), "r.i", "r.t").alias("h")).collect()]
    copies, target, size = plain_mix(rows, hashes)
    want = [i for _, _, i in sorted(copies)]
    out = mixing.placed(docs).collect()
    places = {p: r.doc_id for r in out for p in r.places}
    assert sorted(places) == list(range(len(copies))) and len(out) == len(rows)
    assert collections.Counter(places.values()) == collections.Counter(want)
    at = {r.doc_id: r.positions for r in out}
    exact = {(p, i) for i, ps in at.items() for p in ps}
    near = sorted(copies)
    for (p, i), (q, _, j) in zip(sorted(exact), near, strict=True):
        assert abs(p - q) < 1e-3
    order = [places[k] for k in range(len(copies))]
    assert [i for _, i in sorted((p, i) for p, i in exact)].__len__() == len(order)
    positions = [min(at[i], key=lambda p, k=k: abs(p - near[k][0])) for k, i in enumerate(order)]
    assert all(a <= b + 1e-3 for a, b in zip(positions, positions[1:], strict=False))
    for r in out:
        s = dict((i, s) for i, _, s in rows)[r.doc_id]
        assert r.target == pytest.approx(target[s]) and r.source_size == size[s] and r.taken == r.size * len(r.places) and len(r.places) <= 2
    mixed = mixing.mix(docs)
    assert [r.doc_id for r in mixed.collect()] == order
    assert all(a.position <= b.position for a, b in zip(mixed.collect(), mixed.collect()[1:], strict=False))
