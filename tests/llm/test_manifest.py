"""The manifest against a plain tree builder, with blocks so small that groups have several tiers."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tracelake.llm.manifest import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, POS int, grp string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """Root, and each leaf's siblings from bottom to top as (left, right)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, j in enumerate(at):
            lo = j - j % 3
            paths[i].append(("".join(level[lo:j]), "".join(level[j + 1:lo + 3])))
            at[i] = j // 3
        level = [digest(*level[k:k + 3]) for k in range(0, len(level), 3)]
    return level[0], paths


def plain(rows, seen):
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r), i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    inner = {g: tree([x[2] for x in sorted(groups[g])]) for g in names}
    root, upper = tree([inner[g][0] for g in names])
    out = []
    for g, above in zip(names, upper):
        for (_, _, h, i), path in zip(sorted(groups[g]), inner[g][1]):
            node = leaf(seen(rows[i]))
            for left, right in path + above:
                node = digest(left, node, right)
            out.append((rows[i][0], h, inner[g][0], root, digest(*[x + y for x, y in path + above]), node, node == root))
    return sorted(out, key=repr)


def lost_breaks(row):
    even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
    return (*row[:4], row[4].replace("\n", "") if even and row[4] is not None else row[4])


def check(spark, rows, depth):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    got = manifest(df, observed={"text": F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}, depth=depth)
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in got.select(*cols).collect()), key=repr)
    assert got == plain(rows, lost_breaks)
    return got


@pytest.mark.parametrize("depth", [1, 2, 6])
def test_equals_plain_tree(spark, depth):
    rows = [(i * 7 % 101, f"s{min(i % 40, 9)}", "de", i, f"line {i}\nmore ü" if i % 3 else f"line {i}") for i in range(101)]
    got = check(spark, rows, depth)
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("depth", [1, 6])
def test_nulls_repeats_and_long_texts(spark, depth):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, None, "a", 1, ""), (None, "", "a", 1, "x\ny"),
            (2, "", "b", 2, "x\n" * 200_000), (2, "", "b", 2, "other\n"), (3, "ä", "-", 0, "-"), (4, "z", None, 5, "x"), (-5, "z", None, 5, "x\n")]
    rows += [(9, "hot", "a", 1, "same\n")] * 40
    check(spark, rows, depth)


def test_one_row_and_none(spark):
    (only,) = check(spark, [(4, "s", "a", 1, "x")], 6)
    assert only[1] == only[2] == only[3] and only[4] == digest() and only[6]
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0
