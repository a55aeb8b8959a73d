"""Near-duplicate classes against brute force."""

import random
import re

import numpy as np
import pytest
from conftest import SF01
from llm.conftest import clashing, documents

from rowsieve.llm import near_dedup
from rowsieve.llm.components import components
from rowsieve.llm.near_dedup import M, band_hashes, estimate_reaches, joint_estimate, keep_one, near_duplicates, registers
from rowsieve.llm.tables import shared_folder
from rowsieve.llm.text import mix

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """{id: (set size, smallest id reachable)} from all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df).collect()}


def edited(text, n, rng):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"zz{rng.randrange(10**6)}"
    return " ".join(words)


def test_chains_of_near_copies(spark, prose):
    rng = random.Random(3)
    texts = []
    for g in range(6):
        text = prose(90 + 40 * g, g)
        texts += [text, text.upper(), text.replace(" ", "\n\t ")]
        for _ in range(25):  # copies of copies: a class far wider than one link
            text = edited(text, rng.choice([1, 1, 2, 3]), rng)
            texts.append(text)
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i * 3 - 50, texts[k]) for i, k in enumerate(order)]
    df = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    assert got(df) == brute(rows)


def test_large_group_of_near_copies_in_small_blocks(spark, prose, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 8)  # many pairs of blocks
    rng = random.Random(5)
    base = prose(120, 77)
    rows = [(i, edited(base, rng.choice([0, 1, 2, 4, 8]), rng)) for i in range(120)]
    rows += [(1000 + i, prose(60, 900 + i) + " " + base[:200]) for i in range(30)]  # a passage in common
    assert got(documents(spark, [t for _, t in rows], [i for i, _ in rows])) == brute(rows)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").where("doc_id < 400")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert got(df) == brute(rows)


def test_defined_cases(spark, prose):
    text = prose(50, 1)
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "One"), (6, "one two"), (7, text), (7, text), (9, text), (8, prose(30000, 2))]
    df = clashing(documents(spark, [t for _, t in rows], [i for i, _ in rows]))
    found = sorted(map(tuple, near_duplicates(df).collect()))
    sizes = {7: 46, 9: 46, 8: len(shingles(rows[-1][1]))}
    assert [f for f in found if f[0] < 4] == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
    assert [f for f in found if 4 <= f[0] < 7] == [(4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True)]
    assert [f for f in found if f[0] >= 7] == [(7, sizes[7], 7, True)] * 2 + [(8, sizes[8], 8, True), (9, 46, 7, False)]


def test_null_ids_stay_apart_and_versions_link(spark, prose):
    a, b = prose(40, 1), prose(40, 2)
    df = documents(spark, [a, a, b, b, a], [None, 5, 5, 3, None])  # 5 has two texts, so 3 and 5 are one class
    found = sorted(near_duplicates(df).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in found if r.doc_id is None] == [(None, None, True)] * 2
    assert {(r.doc_id, r.component_id) for r in found if r.doc_id is not None} == {(5, 3), (3, 3)}


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).count() == 0


def test_keep_one(spark, prose):
    a, b = prose(40, 1), prose(40, 2)
    df = clashing(documents(spark, [a, a, b, a, b, None], [4, 2, 3, 2, None, 9]))
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 2), (False, 3), (False, 9), (True, 0)]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.85):
        n = 3000
        common = int(2 * n * share / (1 + share))
        u = rng.integers(0, 2**63, n, dtype=np.uint64)
        v = np.concatenate([u[:common], rng.integers(0, 2**63, n - common, dtype=np.uint64)])
        both = np.unique(np.concatenate([u, v]))
        values = np.concatenate([u, v, both])
        s = registers(values, np.array([0, n, 2 * n, 2 * n + len(both)]))
        assert (np.maximum(s[0], s[1]) == s[2]).all()  # a union's registers
        larger, smaller = (s[0] > s[1]).sum(), (s[0] < s[1]).sum()
        estimate = joint_estimate([n], [n], [larger], [smaller])[0]
        assert abs(estimate - share) < 4 * np.sqrt(share * (1 - share) / M) + 0.01
        for floor in (share - 0.15, share + 0.12):
            assert estimate_reaches(floor, np.array([float(n)]), np.array([float(n)]), larger, smaller)[0] == (estimate >= floor)


def test_bands_find_pairs_at_the_threshold():
    rng = np.random.default_rng(2)
    values, ptr = [], [0]
    for _ in range(200):  # 200 pairs of similarity 0.85
        u = rng.integers(0, 2**63, 370, dtype=np.uint64)
        values += [u, np.concatenate([u[:340], rng.integers(0, 2**63, 30, dtype=np.uint64)])]
        ptr += [ptr[-1] + 370, ptr[-1] + 740]
    bands = band_hashes(registers(np.concatenate(values), np.array(ptr)))
    met = (bands[0::2] == bands[1::2]).any(axis=1)
    assert met.all()
    assert not (bands[0::2] == np.roll(bands[1::2], 1, axis=0)).any()


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(7, 9), (9, 8), (3, 3)], "a long, b long")
    labels = dict(map(tuple, components(links, shared_folder(spark)).collect()))
    assert labels == {i: 100 for i in range(100, 161)} | {7: 7, 8: 7, 9: 7}


def test_mix_is_a_bijection_on_a_sample():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(mix(x))) == len(x)


@pytest.mark.parametrize("n", [1, 2, 3, 300])
def test_sketch_of_any_size(n):
    s = registers(np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.array([0, n, n]))
    assert (s[0] > 0).all() and (s[1] == 0).all()
