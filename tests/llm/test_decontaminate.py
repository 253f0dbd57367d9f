import hashlib
import random
import re

from grantlake.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    wins = []
    for name, text in items:
        w = words(text)
        if w:
            wins += [(name, tuple(w[i : i + window])) for i in range(max(1, len(w) - window + 1))]
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for name, win in wins:
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i : i + len(win)]) == win:
                    hit.update(range(i, i + len(win)))
                    found.add(name)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def cases(seed, vocabulary, n_docs=60):
    rng = random.Random(seed)
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(str(i), " ".join(some(rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(25)] + [("8", None), ("77", "?!")]
    docs = []
    for i in range(n_docs):
        t = some(rng.randrange(0, 80))
        if i % 2:
            piece = words(rng.choice(items)[1])
            a = rng.randrange(len(piece) + 1)
            t[5:5] = piece[a:] if i % 3 else piece
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(t)))
    return [*docs, (900, None), (901, ""), (902, "!!!")], items


def test_scan_matches_brute_force(spark):
    for seed, vocabulary in ((1, ["a", "b"]), (2, ["a", "B", "c", "É", "9"]), (3, [f"w{i}" for i in range(40)])):
        docs, items = cases(seed, vocabulary)
        frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
        for block_words in (300_000, 30):
            found = D.digests(D.scan(frame, bench, block_words=block_words)).collect()
            got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found)
            assert got == brute(docs, items)


def test_cut_removes_the_passages_and_leaves_clean_documents_alone(spark):
    item = "One two three four five six seven eight nine ten eleven twelve"
    docs = [(1, f"Before it. {item}, and after?", 5), (2, "Nothing here.", 13), (3, item, 9), (4, None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_chars long").selectExpr("doc_id", "text", "n_chars", "1 as id", "2 as cut", "3 as items")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r.doc_id: r for r in D.decontaminate(frame, bench).collect()}
    assert sorted(out) == [1, 2, 4] and D.decontaminate(frame, bench).columns == frame.columns
    assert out[1].text == "Before it. and after?" and out[1].n_chars == 21
    assert (out[2].text, out[2].n_chars, out[2]["cut"], out[2]["items"]) == ("Nothing here.", 13, 2, 3)
    assert out[4].text is None and out[4].n_chars is None


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.scan(docs, bench).count() == 0
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert [r.n_hit for r in D.scan(one, bench).collect()] == [0]
