"""The Merkle manifest against a plain recursive tree."""
from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from growthloom.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, path int, root string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climb(nodes):
    """Root and, per leaf, its (left, right) siblings from the bottom up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for k, pos in enumerate(at):
            run, own = runs[pos // 16], pos % 16
            paths[k].append(("".join(run[:own]), "".join(run[own + 1 :])))
            at[k] = pos // 16
        nodes = [digest(*r) for r in runs]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for doc_id, text, lang, source, n in rows:
        groups.setdefault(source, []).append((doc_id, leaf_of(doc_id, source, lang, n, text), (source, lang, n, text)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = climb([x[1] for x in groups[s]])
    root, above = climb([trees[s][0] for s in order])
    out = Counter()
    for s, top in zip(order, above, strict=True):
        for (doc_id, leaf, (source, lang, n, text)), path in zip(groups[s], trees[s][1], strict=True):
            path, cur = path + top, leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                low = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                cur = leaf_of(doc_id, source, lang, n, low)
            for left, right in path:
                cur = digest(left, cur, right)
            out[doc_id, leaf, trees[s][0], root, digest(*[a + b for a, b in path]), cur, cur == root] += 1
    return out


def audited(frame, rows):
    docs = frame([(*r, "x", 1, "y") for r in rows], DOCS)
    return Counter(tuple(r) for r in merkle.audit(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_manifest_against_a_plain_tree(frame, seed):
    rng = random.Random(seed)
    sources = [None, "", "a", "Z", "é", "b"] + [f"s{k}" for k in range(seed * 14)]
    rows = []
    for s, n in zip(sources, [300, 16, 17, 1, 33, 257] + [rng.choice([1, 2, 16, 40]) for _ in sources], strict=False):
        rows += [(len(rows) + k if k else 10_000 + len(rows), rng.choice(["Text", "lower", "", None, "É A", "w " * 20_000]), rng.choice([None, "en"]), s, rng.choice([None, -4, 12])) for k in range(n)]
    rows += [(None, "A", None, "a", 1), (None, "A", None, "a", 1), (7, "A", None, "a", 1), (7, "B", None, "a", 1), (7, "B", None, "a", 1)]
    rng.shuffle(rows)
    got = audited(frame, rows)
    assert got == brute(rows)
    assert {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("rows", [[], [(5, "One", "en", "s", 3)], [(k, "One", "en", "s", 3) for k in range(20)], [(k, "Two", None, f"s{k}", 3) for k in range(18)]])
def test_manifest_of_few_documents_and_of_one_source(frame, rows):
    assert audited(frame, rows) == (brute(rows) if rows else Counter())


def test_a_proof_holds_for_its_document_only(frame):
    rows = [(k, f"text {k}", "en", "ab"[k % 2], 3) for k in range(40)]
    proved = merkle.manifest(frame([(*r, "x", 1, "y") for r in rows], DOCS)).withColumn("up", merkle.fold(merkle.F.col("leaf"), merkle.F.col("path")))
    got = {r["doc_id"]: r for r in proved.collect()}
    assert all(r["up"] == r["root"] for r in got.values())
    assert {len(r["path"]) for r in got.values()} == {3}
    wrong = got[3]["leaf"]
    for left, right in got[4]["path"]:
        wrong = digest(left, wrong, right)
    assert wrong != got[4]["root"]
