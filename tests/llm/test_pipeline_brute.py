"""run() against a plain Python version of all five stages, on documents with nulls, repeats, ties and long texts."""

import collections
import hashlib
import random
import re

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from skyloom.llm import bpe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, position string, size int, id string"
SPACE = re.compile(r"[\x20\x09-\x0d]+")


def words(t):
    return (t or "").encode().split()


def documents():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, base = [], [text(rng.randrange(55, 140)) for _ in range(60)]
    for i, t in enumerate(base):
        rows.append((i, t, f"host{i % 4}"))
        if i % 3 == 0:  # equal but for white space
            rows.append((1000 - i, t.replace(" ", "\n\t", 3), f"host{i % 3}"))
        if i % 4 == 0:  # near: few words changed
            w = t.split()
            w[5] = "changed"
            rows.append((2000 + i, " ".join(w), "host1"))
        if i % 5 == 0:  # related, but below the similarity
            w = t.split()
            w[::9] = ["other"] * len(w[::9])
            rows.append((3000 + i, " ".join(w), None))
    rows += [(5000 + i, text(10), "short.example") for i in range(30)] + [(5100, base[0] + " tail of a bad host", "short.example")]
    rows += [(6000, "same same same " * 60, "host0"), (6001, None, "host0"), (6002, "", "host1"), (6003, " \n ", None), (6004, text(9000), "host2")]
    rows += [rows[0], rows[0], (7000, text(80) + " 中文 éß \U0001f600", "host3")]
    return [(i, t, "en", s, len(t or ""), "k", "p", 1, "x") for i, t, s in rows]


def failed(t):
    w = words(t)
    grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    cover = {j for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    chars = sum(len(x.decode()) for x in w)
    base = len(w) < 50 or 100 * len(cover) > 50 * len(w)
    other = (100 * len(re.findall(r"[#*$%&|<>]", t or "")) > 150 * len(w) or 100 * (len(lines) - len(set(lines))) > 60 * len(lines)
             or not 2 * len(w) <= chars <= 14 * len(w))
    return base, base or other


def after_quality(rows):
    hosts = collections.defaultdict(list)
    for r in rows:
        hosts[r[3]].append(failed(r[1])[1])
    m = sum(map(sum, hosts.values())) / len(rows)
    rates = [sum(x) / len(x) for x in hosts.values()]
    mean = sum(rates) / len(rates)
    v = sum((x - mean) ** 2 for x in rates) / (len(rates) - 1)
    a = min(1e4, max(1.0, m * (1 - m) / v - 1)) if v else 1e4
    bad = {h for h, x in hosts.items() if (sum(x) + a * m) / (len(x) + a) > 0.6}
    return [r for r in rows if not failed(r[1])[0] and r[3] not in bad], bad


def after_exact(rows):
    best = {}
    for r in rows:
        k = SPACE.sub(" ", r[1] or "")
        if k not in best or r[0] < best[k][0]:
            best[k] = r
    return list(best.values())


def after_near(rows):
    sets = []
    for r in rows:
        w = [x.lower() for x in words(r[1])]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    label = {i: i for i in range(len(rows))}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    first = {}
    for i, r in enumerate(rows):
        first[root(i)] = min(first.get(root(i), r[0]), r[0])
    return [r for i, r in enumerate(rows) if first[root(i)] == r[0]]


def after_mixing(spark, rows):
    seeds = spark.createDataFrame([(r[0], r[1]) for r in rows], "i long, t string").select("i", F.xxhash64(F.lit(17), "i", "t").alias("h"))
    h = {r.i: r.h for r in seeds.collect()}
    by = collections.defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    names = sorted(x for x in by if x is not None) + [None] * (None in by)
    size = {s: sum(len(words(r[1])) for r in by[s]) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, target, free = 1.5 * sum(size.values()), {}, set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        for s in over or free:
            target[s] = 2.0 * size[s] if over else level * weight[s]
            left -= target[s] if over else 0
        free -= over or free
    out = []
    for s in names:
        at = 0
        for r in sorted(by[s], key=lambda r: h[r[0]]):
            n = len(words(r[1]))
            out += [r for e in range(2) if at + e * size[s] + n / 2 < target[s]]
            at += n
    return out


def test_run_against_plain_python(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    good, bad = after_quality(rows)
    assert bad == {"short.example"} and len(good) < len(rows)
    one = after_exact(good)
    apart = after_near(one)
    assert len(good) > len(one) > len(apart)
    mixed = after_mixing(spark, apart)
    enc = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    want = collections.Counter()
    for r in mixed:
        ids = enc.encode_ordinary(r[1])
        want[(r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest())] += 1
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert collections.Counter(map(tuple, out.collect())) == want


def test_stages_one_by_one(spark, tmp_path):
    """Nulls in every column, repeated rows and an empty table; all columns come back."""
    rows = [(None, None, None, None, None, None, None, None, None)] * 2 + [(1, " ".join(f"w{i}" for i in range(60)), None, None, None, None, None, None, None)] * 2
    rows += [(None, rows[-1][1] + " x", "en", "s", 1, "k", "p", 1, "x")]
    for data in (rows, []):
        docs = spark.createDataFrame(data, SCHEMA)
        sizes = []
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{len(data)}-{k}")
            stage(spark, docs, "").write.parquet(path)
            docs = spark.read.parquet(path)
            sizes.append(docs.count())
            if k < 4:
                assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
        assert sizes == ([3, 2, 1, 1, 1] if data else [0] * 5)


def test_near_copies_without_an_id(spark):
    """One row of each group stays, with an id where there is one; a row without one doesn't bring others back."""
    base = [f"w{i}" for i in range(200)]
    copies = [" ".join(base[:-1] + [x]) for x in ("a", "b", "c")]
    other = [" ".join(f"v{i}" for i in range(200)) + x for x in ("", " end")]
    rows = [(None, copies[0]), (None, copies[1]), (7, copies[2]), (None, other[0]), (None, other[1]), (None, "alone here"), (9, "with an id")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "k", "p", 1, "x") for i, t in rows], SCHEMA)
    left = [(r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)["near dedup"](spark, docs, "").collect()]
    assert len(left) == 4 and {(7, copies[2]), (None, "alone here"), (9, "with an id")} < set(left)
    assert sum(t in other for _, t in left) == 1


def test_runs_in_threads_keep_their_tables(spark, tmp_path):
    """Two runs at once in one driver: neither deletes the other's work tables."""
    from concurrent.futures import ThreadPoolExecutor

    spark.createDataFrame(documents(), SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    with ThreadPoolExecutor(2) as pool:
        outs = list(pool.map(lambda _: collections.Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())), range(2)))
    assert outs[0] == outs[1] and outs[0]
