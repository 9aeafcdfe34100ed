from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from larderline.llm import simhash
from larderline.llm.components import least_reachable

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [word for word in lowered.split(" ") if word]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    """Smallest reachable id for each row, by comparing all pairs."""
    prints = [plain_fingerprint(text) for _, text in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (doc_id, _) in zip(group, rows, strict=True):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return [(f"{p:016x}", least.get(g)) for p, g in zip(prints, group, strict=True)]


def documents():
    draw = random.Random(5)
    words = [f"w{n}" for n in range(200)]
    rows = [(None, "only one of its kind"), (1, None), (2, ""), (3, " \n\t"), (4, "Two words")]
    rows += [(5, "two WORDS"), (6, "two words"), (7, "é É e"), (8, "two words"), (8, "two words")]
    for base in range(12):
        text = draw.choices(words, k=400)
        for copy in range(6):
            changed = list(text)
            for _ in range(copy):
                changed[draw.randrange(400)] = draw.choice(words)
            rows.append((100 + 10 * base + copy, " ".join(changed)))
    return rows


@pytest.mark.parametrize("block", [simhash.BLOCK, 2])
def test_groups_are_those_of_all_pairs(spark, block):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    found = simhash.near_copies(docs, block=block).collect()
    got = [(f"{r.fingerprint % 2**64:016x}", r.id, r.component) for r in found]
    key = lambda row: (row[0], row[1] is None, row[1] or 0)
    wanted = [(p, r[0], least) for r, (p, least) in zip(rows, plain_groups(rows), strict=True)]
    assert sorted(got, key=key) == sorted(wanted, key=key)
    groups = {r.component if r.component is not None else -1 for r in found}
    assert sum(r.stays for r in found) == len(groups)


def test_stays_keep_whole_rows_of_any_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d", "x", 7), (1, "a b c d", "x", 7), (2, "A b c d", None, 8)],
        "doc_id long, text string, fingerprint string, component int",
    )
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert kept.collect() == [(1, "a b c d", "x", 7)]


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_copies(docs).count() == 0
    assert simhash.drop_near_copies(docs).columns == ["doc_id", "text"]


def test_links_at_three_bits_and_not_at_four(spark):
    draw = np.random.default_rng(3)
    prints = draw.integers(0, 2**63, 40, dtype=np.int64)
    rows = set()
    for value in prints.tolist():
        rows.add(value)
        for bits in (3, 4):
            mask = sum(1 << int(b) for b in draw.choice(63, bits, replace=False))
            rows.add(value ^ mask)
    rows = sorted(rows)
    links = simhash.near_links(spark.createDataFrame([(r,) for r in rows], "fingerprint long"))
    found = {tuple(sorted(r)) for r in links.collect()}
    near = {(a, b) for a in rows for b in rows if a < b and (a ^ b).bit_count() <= 3}
    assert found == near
    with pytest.raises(ValueError, match="3 differing bits"):
        simhash.near_links(spark.range(1).withColumnRenamed("id", "fingerprint"), most_bits=4)


def test_very_long_text_is_read_whole():
    words = [f"w{n % 977}" for n in range(200_000)]
    assert simhash.fingerprint(" ".join(words[:3000])) == plain_fingerprint(" ".join(words[:3000]))
    assert simhash.fingerprint(" ".join(words)) != simhash.fingerprint(" ".join(words[:300]))


def test_components_of_paths_stars_and_rings(spark):
    path = [(n, n + 1) for n in range(60)]
    star = [(1000, 1001 + n) for n in range(300)]
    ring = [(2000 + n, 2000 + (n + 1) % 7) for n in range(7)]
    loops = [(5000, 5000), (None, 1), (2, None)]
    links = spark.createDataFrame([*path, *star, *ring, *loops, *star], "a long, b long")
    found = {r.node: r.least for r in least_reachable(links.orderBy(F.rand(1))).collect()}
    wanted = {n: 0 for n in range(1, 61)}
    wanted |= {1001 + n: 1000 for n in range(300)} | {2000 + n: 2000 for n in range(1, 7)}
    assert found == wanted
