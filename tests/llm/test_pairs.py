"""Lines, phrases, fingerprints, shards and near duplicates against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_frames import FOLDER, LONG, texts_of
from tidemark.llm import (
    hilbert_shards,
    line_dedup,
    phrase_index,
    queries,
    rare_digest,
    shingles,
    tensor_minhash,
)
from tidemark.llm import components as linked
from tidemark.llm.components import components, stored
from tidemark.session import new_scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(ready, duck, name):
    got = queries.QUERIES[name](ready, FOLDER)
    expected = duck.sql(queries.ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    rows = sorted(tuple(r[c] for c in columns) for r in got.collect())
    assert rows == sorted(expected.project(", ".join(columns)).fetchall())


# Lines


def removed_by_brute_force(rows):
    seen, gone = [], set()
    for own, text in sorted(rows, key=lambda r: r[0]):
        for number, line in enumerate((text or "").split("\n")):
            found = set(words(line))
            if not found:
                continue
            if any(5 * len(found & o) >= 4 * len(found | o) for o in seen):
                gone.add((own, number))
            seen.append(found)
    return gone


def test_lines_with_small_edits(ready):
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(120):  # copies with up to nine words of forty replaced, and short lines
        line = list(base)
        for j in range(i % 10):
            line[(i * 7 + j * 3) % 40] = f"x{i}_{j}"
        rows.append((i, " ".join(line) + f"\nshort {i % 7} line\nSHORT  line {i % 7}\na b c d e{i % 3}"))
    frame = ready.createDataFrame(rows, "doc_id long, text string")
    found = {tuple(r) for r in line_dedup.removed_lines(frame).collect()}
    assert found == removed_by_brute_force(rows)
    left = {r["doc_id"]: r["text"] for r in line_dedup.without_lines(frame).collect()}
    for own, text in rows:
        kept = [x for n, x in enumerate(text.split("\n")) if (own, n) not in found]
        assert left[own] == "\n".join(kept)


def test_pairs_of_sorted_postings(monkeypatch):
    """Whatever the sizes of blocks, all similar pairs meet, once for a run of tokens at most."""
    random = np.random.default_rng(3)
    for long in (1 << 40, 8):  # a map of one part, of three
        monkeypatch.setattr(line_dedup, "LONG", long)
        sets = []
        for i in range(150):
            size = int(random.integers(1, 30))
            sets.append(set(random.choice(30, size, replace=False).tolist()))
        rows = []
        for i, tokens in enumerate(sets):
            maps = [0, 0, 0]
            for t in tokens:
                maps[t % 3 if len(tokens) >= long else 0] ^= 1 << (t * 7 % 64)
            order = sorted(tokens)
            prefix = order[: int(line_dedup.prefix_size(np.array([len(order)]), 80)[0])]
            for at, t in enumerate(prefix):
                before = prefix[at - 1] if at else 0
                done = int(i % 5 == 0)
                rows.append((((t - 15) << 32) | len(order), i // 2, (i % 2) << 32 | 2 * at + done, before, *maps))
        rows.sort()
        rows = dict(zip(line_dedup.POSTING, map(np.array, zip(*rows))))
        rows |= {m: rows[m].astype(np.uint64) for m in line_dedup.MAPS}
        want = {
            (i, j)
            for i, a in enumerate(sets)
            for j, b in enumerate(sets[:i])
            if i % 5 and a != b and 5 * len(a & b) >= 4 * len(a | b)
        }
        for most in (1, 7, 1 << 20):
            monkeypatch.setattr(line_dedup, "CHUNK_PAIRS", most)
            met = []
            for late, soon in line_dedup._pairs_of(rows, 0, 80):
                both = [(2 * rows["id"][x] + (rows["spot"][x] >> 32)).tolist() for x in (late, soon)]
                met += zip(*both)
            assert want <= set(met) and all(i > j and i % 5 for i, j in met)
            assert all(4 * max(map(len, p)) <= 5 * min(map(len, p)) for p in ((sets[i], sets[j]) for i, j in met))
        assert len(want) > 5


def test_tokens_of_lines_are_sorted_once(ready, monkeypatch):
    plans = {}

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, name)

    monkeypatch.setattr(line_dedup, "stored", watched)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(60):
        line = list(base)
        for j in range(i % 10):
            line[(i * 11 + j * 3) % 40] = f"x{i}_{j}"
        rows.append((i, " ".join(line[: 40 - i % 3])))
    frame = ready.createDataFrame(rows, "doc_id long, text string")
    for most in (20, 200_000):
        monkeypatch.setattr(line_dedup, "CHUNK_ROWS", most)
        found = {tuple(r) for r in line_dedup.removed_lines(frame).collect()}
        assert found == removed_by_brute_force(rows)
    assert "SortMergeJoin [token" not in plans["rest"] and "place" in plans["rest"]
    assert "REPARTITION_BY_COL" in plans["shared"] and "ENSURE_REQUIREMENTS" not in plans["shared"]


def test_lines_of_odd_rows(odd, empty):
    rows = line_dedup.line_counts(odd).collect()
    assert len(rows) == odd.count()
    removed = Counter((r["doc_id"], r["n_removed"]) for r in rows)
    assert removed[(5, 0)] == 2 and removed[(6, 1)] == 1 and removed[(4, 0)] == 1
    left = line_dedup.without_lines(odd)
    assert left.columns == odd.columns and left.count() == odd.count()
    assert left.filter("doc_id = 6").first()["text"] == ""
    assert left.filter("doc_id = 1").first()["text"] is None
    assert left.filter("doc_id = 4").first()["text"] == LONG
    assert line_dedup.removed_lines(empty).count() == 0
    assert line_dedup.without_lines(empty).count() == 0


# Phrases

ITEM = " ".join(f"t{i}" for i in range(14))


def test_phrases_of_odd_rows(ready, odd, empty):
    items = [(1, ITEM), (2, ITEM), (None, "only this"), (3, None), (4, "!!"), (5, "x")]
    bench = ready.createDataFrame(items, "item_id long, text string")
    rows = ready.createDataFrame(
        [
            (20, f"A {ITEM.upper()} b {ITEM}"),
            (21, " ".join(ITEM.split()[2:12]) + " only THIS"),
            (22, " ".join(ITEM.split()[2:11])),
        ],
        "doc_id long, text string",
    )
    frame = odd.select("doc_id", "text").union(rows)
    found = phrase_index.contamination(frame, bench, new_scratch_path(ready, "index")).collect()
    assert len(found) == frame.count()
    by_id = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in found}
    assert by_id[20] == (30, 28, ["1", "2"])
    assert by_id[21] == (12, 12, ["1", "2"])
    assert by_id[22] == (9, 0, [])
    assert by_id[9] == (1, 1, ["5"]) and by_id[1] == (0, 0, []) and by_id[2] == (0, 0, [])
    none = phrase_index.contamination(empty, bench, new_scratch_path(ready, "index"))
    assert none.count() == 0
    nothing = phrase_index.contamination(frame, bench.filter("false"), new_scratch_path(ready, "index"))
    assert {r["n_hit"] for r in nothing.collect()} == {0}


def test_phrases_in_several_blocks(ready, docs, monkeypatch):
    bench = ready.read.parquet(f"{FOLDER}/benchmark.parquet")
    once = phrase_index.contamination(docs, bench, new_scratch_path(ready, "index"))
    want = {r["doc_id"]: tuple(map(str, r)) for r in once.collect()}
    monkeypatch.setattr(phrase_index, "BLOCK_BYTES", 4000)
    blocks = phrase_index.contamination(docs, bench, new_scratch_path(ready, "index"))
    assert {r["doc_id"]: tuple(map(str, r)) for r in blocks.collect()} == want


def test_words_close_together(ready):
    frame = ready.createDataFrame(
        [(1, "red and big fox"), (2, "red a b c d e f g fox"), (3, "fox")], "doc_id long, text string"
    )
    index = ready.read.parquet(phrase_index.build_index(frame, new_scratch_path(ready, "index")))
    near = phrase_index.find_near(index, [("i", [b"red", b"fox"])], slack=3)
    assert [tuple(r) for r in near.collect()] == [("i", 1, 1)]


def test_three_words_close_together_whatever_the_neighbours(ready):
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = ready.conf.get(size)
    found = []
    try:
        for other in ("red red", "and and", "fox fox"):
            for rows in ("1", "1000"):
                ready.conf.set(size, rows)
                texts = [(1, "red a b and c d fox"), (2, other), (3, other)]
                frame = ready.createDataFrame(texts, "doc_id long, text string").coalesce(1)
                index = ready.read.parquet(phrase_index.build_index(frame, new_scratch_path(ready, "index")))
                for slack in (3, 5, 6):
                    near = phrase_index.find_near(index, [("i", [b"red", b"and", b"fox"])], slack=slack)
                    found.append((slack, [tuple(r) for r in near.collect()]))
    finally:
        ready.conf.set(size, before)
    assert found == [(3, []), (5, []), (6, [("i", 1, 1)])] * 6


# Fingerprints


def test_digests_of_odd_rows(odd, empty, ready):
    for ranges in (1, 50):
        rows = rare_digest.rare_digests(odd, ranges=ranges).collect()
        own = sorted(
            ((r["doc_id"], r["text"] or "") for r in odd.collect()),
            key=lambda r: 1 if r[0] is None else -r[0],
        )
        assert [r["doc_id"] for r in sorted(rows, key=lambda r: 1 if r[0] is None else -r[0])] == [
            i for i, _ in own
        ]
        by_id = {}
        for r in rows:
            by_id.setdefault(r["doc_id"], []).append(r)
        for (i, text), (_, following) in zip(own, own[1:] + own[:1]):
            half = len(text) // 2
            new = text[: len(text) - half] + following[:half]
            if i not in (None, 1):  # the rows without id have two orders
                sha = hashlib.sha256(new.encode()).hexdigest()
                assert any(r["edited_sha256"] == sha and r["n_chars"] == len(text) for r in by_id[i])
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
        assert by_id[6][0]["near_next"] == 1.0 and by_id[2][0]["fingerprint"] == ""
        assert by_id[5][0]["fingerprint"] == by_id[6][0]["fingerprint"] != by_id[9][0]["fingerprint"]
    assert rare_digest.rare_digests(empty).count() == 0
    alone = rare_digest.rare_digests(odd.filter("doc_id = 7")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0


def test_entropy_levels_by_brute_force():
    import numpy as np

    data = np.frombuffer(LONG[479_900:480_300].encode(), np.uint8)
    found = rare_digest.levels(data)
    for i in range(0, len(found), 7):
        counts = np.bincount(data[i : i + 64])
        whole = rare_digest.WEIGHT[counts].sum()
        assert found[i] == (rare_digest.WHOLE - whole) * 1000 // rare_digest.WHOLE


def test_digests_do_not_depend_on_neighbours(docs):
    rank = rare_digest.level_ranks(docs)
    texts = [t.encode() for t in texts_of(docs)[:40]]
    together = rare_digest.fingerprints(texts, rank)
    assert together == [rare_digest.fingerprints([t], rank)[0] for t in texts]
    assert rare_digest.likeness(together[0], together[0]) == 1.0


def test_edits_of_short_texts_are_near(ready):
    import random

    draw = random.Random(3)
    rows = []
    for i, size in enumerate(list(range(24, 600, 3)) * 2):
        text = ""
        while len(text) < size:
            text += "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(2, 9))) + " "
        rows.append((i, text[:size]))
    found = rare_digest.rare_digests(ready.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["near_edited"] > (0.1 if r["n_chars"] >= 48 else 0), (r["n_chars"], r["near_edited"])
    assert sum(r["near_next"] > 0.1 for r in found) <= 0.02 * len(found)


def further_features(text, rank):
    """The further windows of one text that are the leftmost rarest of a run, one by one."""
    import numpy as np

    found = []
    for kind, (window, below, run) in enumerate(rare_digest.FURTHER, 1):
        windows = [text[i : i + window] for i in range(len(text) - window + 1)]
        if not windows or len(text) >= below:
            continue
        whole = int(rare_digest.WEIGHT[window])
        own = []
        for w in windows:
            used = int(rare_digest.WEIGHT[np.bincount(np.frombuffer(w, np.uint8))].sum())
            own.append(int(rank[kind][(whole - used) * 1000 // whole]))
        run = min(run, len(own))
        best = {min(range(i, i + run), key=lambda j: (own[j], j)) for i in range(len(own) - run + 1)}
        found.extend(windows[i] for i in sorted(best) if own[i] <= rare_digest.LEVELS)
    return found


def test_digests_of_short_texts_by_brute_force(docs):
    import numpy as np

    rank = rare_digest.level_ranks(docs)
    texts = [t.encode()[:size] for t, size in zip(texts_of(docs), range(8, 64))]
    texts = [t for t in texts if len(t) >= 8]
    for text, made in zip(texts, rare_digest.fingerprints(texts, rank)):
        bits = np.zeros(rare_digest.FILTER_BITS, np.uint8)
        features = further_features(text, rank)
        for feature in features:
            value = int(rare_digest.mixed(np.frombuffer(feature, np.uint64)[None])[0])
            for h in range(rare_digest.HASHES):
                bits[value >> 11 * h & rare_digest.FILTER_BITS - 1] = 1
        assert not features or made == np.packbits(bits).tobytes()


# Shards


def point(index, dims, bits):
    """Cells of a curve index, by Skilling's inverse."""
    x = [0] * dims
    for b in range(bits * dims):
        bit = index >> (bits * dims - 1 - b) & 1
        x[b % dims] |= bit << (bits - 1 - b // dims)
    t = x[-1] >> 1
    for i in range(dims - 1, 0, -1):
        x[i] ^= x[i - 1]
    x[0] ^= t
    q = 2
    while q != 1 << bits:
        for i in range(dims - 1, -1, -1):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q <<= 1
    return x


def test_hilbert_index_is_the_curve(ready):
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        frame = ready.range(1 << (dims * bits)).select(
            *[F.expr(f"cast(id >> {bits * i} as int) & {(1 << bits) - 1}").alias(f"c{i}") for i in range(dims)]
        )
        cells = [f"c{i}" for i in range(dims)]
        rows = frame.withColumn("h", hilbert_shards.hilbert_index([F.col(c) for c in cells], bits)).collect()
        by_index = {r["h"]: [r[c] for c in cells] for r in rows}
        assert sorted(by_index) == list(range(1 << (dims * bits)))
        assert all(by_index[i] == point(i, dims, bits) for i in by_index)
        steps = [
            sum(abs(a - b) for a, b in zip(by_index[i], by_index[i + 1])) for i in range(len(by_index) - 1)
        ]
        assert set(steps) == {1}


def check_shards(rows, total):
    shards = {}
    for r in rows:
        shards.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(shards.get(s, [])) for s in range(8)]
    assert sum(counts) == total and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())


def test_shards(ready, docs):
    rows = queries.op9_hilbert_shards(ready, FOLDER).collect()
    check_shards(rows, docs.count())
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))


def test_shards_of_odd_rows(ready, odd, empty):
    dims = {"size": F.octet_length("text").cast("long"), "source": F.col("source")}
    check_shards(hilbert_shards.hilbert_shards(odd, dimensions=dims).collect(), odd.count())
    assert hilbert_shards.hilbert_shards(empty, dimensions=dims).count() == 0
    clashing = odd.drop("shard", "slot").withColumns({"shard": F.lit("x"), "slot": F.lit(1)})
    target = hilbert_shards.write_shards(clashing, new_scratch_path(ready, "s"), dimensions=dims)
    written = ready.read.parquet(target)
    assert written.count() == odd.count()
    assert {*clashing.columns, "shard_", "slot_"} == {*written.columns}


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_text_cuts_are_of_equal_depth(ready, bits):
    texts = [f"common_crawl_{i}" for i in range(5) for _ in range(i + 1)] * 9 + ["zz", "", "a" * 99]
    df = ready.createDataFrame([(t,) for t in [*texts, None]], "t string").repartition(7)
    found = hilbert_shards.cut_points(df, [F.col("t")], bits)[0]
    texts.sort()
    cells = 1 << bits
    want = {texts[-(-k * len(texts) // cells) - 1] for k in range(1, cells)}
    assert found == sorted(want)
    assert hilbert_shards.text_cuts(df.limit(0), F.col("t"), bits) == []


def test_long_equal_beginnings_have_cells_of_their_own(ready):
    df = ready.createDataFrame([(f"common_crawl_{i % 5}",) for i in range(500)], "t string")
    cuts = hilbert_shards.cut_points(df, [F.col("t")])[0]
    cells = df.select("t", hilbert_shards.cell(F.col("t"), cuts).alias("c")).distinct().collect()
    assert len({r["c"] for r in cells}) == 5


def test_shards_use_dataframe_functions_only(docs):
    dims = {"size": F.octet_length("text").cast("long")}
    plan = hilbert_shards.hilbert_shards(docs, dimensions=dims)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# Near duplicates


def components_by_brute_force(rows, size, percent):
    sets = []
    for own, text in rows:
        w = words(text)
        whole = {tuple(w)} if w else set()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or whole)
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    least = {}
    for i, (own, _) in enumerate(rows):
        least.setdefault(top(i), []).append(own)
    return {own: min(least[top(i)]) for i, (own, _) in enumerate(rows)}


def test_chains_of_copies(ready):
    """Each copy is near the one before, so a group is linked only by all its links."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for g in range(3):
        line = [f"{g}{w}" for w in base]
        for i in range(40):
            rows.append((1000 * g + (i * 17) % 40, " ".join(line)))
            for j in range(2):
                line[(i * 5 + j) % 200] = f"{g}x{i}_{j}"
    rows += [(5000, "a b"), (5001, "A  b"), (5002, "b a"), (5003, "a"), (5004, ""), (5005, None)]
    frame = ready.createDataFrame(rows, "doc_id long, text string")
    for size, percent in ((3, 85), (5, 80)):
        found = tensor_minhash.near_duplicates(frame, shingle=size, percent=percent).collect()
        assert {r["doc_id"]: r["component_id"] for r in found} == components_by_brute_force(rows, size, percent)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = tensor_minhash.near_duplicates(odd, shingle=3, percent=85).collect()
    assert len(rows) == odd.count()
    found = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in rows)
    assert found[(None, None, True)] == 2 and found[(5, 5, True)] == 2 and found[(6, 5, False)] == 1
    assert found[(1, 1, True)] == found[(2, 2, True)] == found[(3, 3, True)] == 1
    assert tensor_minhash.near_duplicates(empty).count() == 0


def test_tensored_keys_need_few_minhashes():
    groups = tensor_minhash.groups_for(0.85)
    assert groups == (8, 11)  # 88 tables, from 19 groups
    missed = [(1 - 0.85**size) ** n for size, n in zip(tensor_minhash.GROUPS, groups)]
    assert sum(missed) <= 1e-4


def test_components(ready):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 50), (200, 201), (201, 200), (7, 7), (None, 1)]
    found = components(ready.createDataFrame(edges, "u long, v long")).collect()
    want = {**{i: 1 for i in [*range(1, 61), 100]}, 200: 200, 201: 200}
    assert {r["id"]: r["component"] for r in found} == want and len(found) == len(want)
    assert components(ready.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("few", (0, 100))
def test_few_edges_are_not_shuffled(ready, monkeypatch, few):
    plans = []

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(linked, "stored", watched)
    monkeypatch.setattr(linked, "FEW", few)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 50), (200, 201), (201, 200), (7, 7), (None, 1)]
    found = components(ready.createDataFrame(edges, "u long, v long")).collect()
    want = {**{i: 1 for i in [*range(1, 61), 100]}, 200: 200, 201: 200}
    assert {r["id"]: r["component"] for r in found} == want and len(found) == len(want)
    assert any("hashpartitioning" in p for p in plans) == (few == 0)


def test_tables_without_other_components_are_left_alone(ready, monkeypatch):
    names = []

    def watched(df, name):
        names.append(name)
        return stored(df, name)

    monkeypatch.setattr(tensor_minhash, "stored", watched)
    text = " ".join(f"w{i}" for i in range(60))
    frame = ready.createDataFrame([(1, text), (2, text + " a"), (3, "b " + text)], "doc_id long, text string")
    found = tensor_minhash.near_duplicates(frame, shingle=3, percent=85).collect()
    assert {r["component_id"] for r in found} == {1}
    assert names.count("pairs") == names.count("links") == 1


def thue_morse(size):
    """A word and its complement, whose sums of bytes times powers are equal modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(size)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("size", (1024, 4096))
def test_words_made_to_collide_are_told_apart(ready, size):
    a, b = thue_morse(size)
    rows = ready.createDataFrame([(1, f"{a} one two"), (2, f"{b} one two")], "doc_id long, text string")
    found = tensor_minhash.near_duplicates(rows, shingle=3, percent=85).collect()
    assert {r["component_id"] for r in found} == {1, 2}
    assert line_dedup.removed_lines(rows).count() == 0


def test_hash_depends_on_every_byte_and_place():
    words = [b"", b"a", b"aa", b"a" * 8, b"a" * 9, b"a" * 16, b"a" * 17, b"b" + b"a" * 16, b"a" * 16 + b"b"]
    words += [b"a" * 8 + b"b" * 8, b"b" * 8 + b"a" * 8, b"abcdefgh" * 3, b"\x00", b"a\x00", b"\x00a"]
    hashes, starts, owner = shingles.word_hashes(words)
    assert len(set(hashes.tolist())) == len(words) - 1  # the empty text has no word
    alone = [shingles.word_hashes([w])[0].tolist() for w in words]
    assert sum(alone, []) == hashes.tolist() and owner.tolist() == list(range(1, len(words)))
