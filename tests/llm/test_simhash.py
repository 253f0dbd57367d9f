import random

import numpy as np

from grantlake.llm import simhash as S


def slow_fingerprint(text, width=4):
    import xxhash

    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(ids, fps, limit=4):
    up = list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= limit:
                up[root(i)] = root(j)
    groups = {}
    for i, x in enumerate(ids):
        groups.setdefault(root(i), []).append(x)
    return [min(groups[root(i)]) for i in range(len(ids))]


def test_fingerprint_by_definition():
    for text in (None, "", " \t\n", "One", "a b c d", "É Ünï a b C  d\x0be f g " * 3, "x y z " * 40):
        assert S.fingerprint(text) == slow_fingerprint(text)


def test_golay_code_is_perfect():
    words = np.arange(1 << 23, dtype=np.int32)
    index = S.decode(words[::97])
    assert index.min() >= 0 and index.max() < 4096
    counts = np.bincount(S.decode(words), minlength=4096)
    assert (counts == 2048).all()


def test_close_segments_share_a_key():
    rng = random.Random(1)
    for width in (21, 22):
        for _ in range(300):
            a = rng.getrandbits(width)
            b = a ^ sum(1 << i for i in rng.sample(range(width), rng.randrange(3)))
            x, y = (set(S.segment_keys(np.array([v]), width)[0]) - {-1} for v in (a, b))
            assert x & y


def test_links_lose_nothing_even_over_the_block_size(spark):
    rng = random.Random(2)
    fps = []
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            fps.append(base ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(6))))
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = brute(list(range(len(fps))), fps)
    for most in (1 << 15, 9):
        frame = spark.createDataFrame([(s,) for s in signed], "fp bigint")
        edges, _ = S.links(frame, most=most)
        roots = {r.node: r.root for r in S.connected_components(edges)[0].collect()}
        got = {}
        for i, s in enumerate(signed):
            got.setdefault(roots.get(s, s), []).append(i)
        assert sorted(got.values()) == sorted([i for i, w in enumerate(want) if w == r] for r in set(want))


def test_components_match_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", "  ", "one", "ONE"]
    for _ in range(30):
        t = [rng.choice(words) for _ in range(rng.randrange(3, 200))]
        texts.append(" ".join(t))
        for _ in range(rng.randrange(4)):
            u = list(t)
            u[rng.randrange(len(u))] = "changed"
            texts.append(" ".join(u))
    rows = [(7 * i + 3, t, i) for i, t in enumerate(texts)] + [(3, None, -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int").repartition(3)
    got = sorted((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in S.simhash_components(docs).collect())
    fps = [slow_fingerprint(t) for _, t, _ in rows]
    want = sorted(zip([r[0] for r in rows], fps, brute([r[0] for r in rows], fps)))
    assert got == want
    kept = S.near_dedup(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted({w[2] for w in want})
    assert S.near_dedup(docs).columns == docs.columns


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.simhash_components(empty).count() == 0 and S.near_dedup(empty).count() == 0
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (5, "a b"), (None, "c d e f g")], "doc_id long, text string")
    assert sorted(str(r.component_id) for r in S.simhash_components(docs).collect()) == ["5", "5", "5", "None"]
    assert S.near_dedup(docs).count() == 4
