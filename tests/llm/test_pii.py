import re

from grantlake.llm import pii as P

DOCS = [
    (1, "Call +1 (017) 555-7713 or (212) 555-0001. Mail Ann.Lee@mail7.example.com, ann.lee@MAIL7.example.com", 9),
    (2, "+1-017-555-7713 again; card 4845168114407329, 4845 1681 1440 7329; ip 10.2.3.4. token = \"" + "ab" * 20 + '"', 9),
    (3, "Frau Özil met Mr. Ivan Petrov, Mrs Smith and Herr Özil; Mr Иванов", 9),
    (4, "SSN 123-45-6789 v1.2.3.4.5 no 12345", 9), (5, None, 9), (6, "", 9), (7, "@ nothing 1", 9),
]


def found(text):
    return re.findall(r"\S+@\S+[a-z]", text), re.findall(r"\b\d{16}\b|\d{4} \d{4} \d{4} \d{4}", text)


def test_surrogates_keep_format_and_coreference(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, n_entities int")
    out = {r.doc_id: r for r in P.pseudonymise(docs, "secret").collect()}
    assert [out[i].n_entities for i in range(1, 8)] == [4, 5, 5, 1, 0, 0, 0]
    a, b = out[1].text, out[2].text
    m = re.fullmatch(r"Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or \(\d{3}\) \d{3}-\d{4}\. Mail (\S+), (\S+)", a)
    assert m and m[4].lower() == m[5].lower() != "ann.lee@mail7.example.com" and m[4][0].isupper() and re.fullmatch(r"[A-Za-z]{3}\.[A-Za-z]{3}@[a-z]{4}\d\.example\.org", m[4])
    assert b.startswith(f"+1-{m[1]}-{m[2]}-{m[3]} again")
    plain, spaced = found(b)[1]
    assert spaced.replace(" ", "") == plain != "4845168114407329" and "10.2.3.4" not in b and re.search(r'"[0-9a-f]{40}"', b) and "ab" * 20 not in b
    c = re.fullmatch(r"Frau ([A-ZÖ]\w+a) met Mr\. (\w+ \w+), Mrs (\w+a) and Herr (\w+); Mr ([А-Я][а-я]+)", out[3].text)
    assert c and c[1] != c[4] and re.match(r"SSN \d{3}-\d\d-\d{4} v1\.2\.3\.4\.5 no 12345$", out[4].text)
    assert out[5].text is None and (out[6].text, out[7].text) == ("", "@ nothing 1")
    again = {r.doc_id: r.text for r in P.pseudonymise(docs, "secret", literal=-1).collect()}
    assert again == {i: r.text for i, r in out.items()}
    assert {r.doc_id: r.text for r in P.pseudonymise(docs, "other").collect()} != again


def test_collisions_are_drawn_again(spark):
    # Ten thousand cards whose format allows 10^13, and names of two letters of which there are few.
    names = [f"Mr {a}{b}" for a in "ABCDEFGHIJ" for b in "abcdefghij"]
    docs = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "doc_id long, text string")
    out = [r.text for r in P.pseudonymise(docs, "k").collect()]
    assert len(set(out)) == len(names) and not set(out) & set(names)
    assert sorted(out) == sorted(r.text for r in P.pseudonymise(docs, "k", literal=3).collect())


def test_empty(spark):
    assert P.pseudonymise(spark.createDataFrame([], "doc_id long, text string"), "k").count() == 0


def test_more_entities_than_their_format_has_surrogates(spark, monkeypatch):
    monkeypatch.setattr(P, "ATTEMPTS", 1)
    names = [f"Ms {a}{b}" for a in "ABCDEFGH" for b in "aeiou"]  # 16 surrogates of two letters
    out = [r.text for r in P.pseudonymise(spark.createDataFrame(list(enumerate(names)), "doc_id long, text string"), "k").collect()]
    assert len({x.lower() for x in out}) == len(names) and not set(out) & set(names) and all(re.fullmatch("Ms [A-Z][a-z]*a", x) for x in out)


def test_spellings_of_a_phone_share_their_digits(spark):
    same = [("+1 555 010 0200", "+15550100200", "+1-555-010-0200"), ("+44 20 7946 0958", "+442079460958"), ("+353 20 912 3456", "+353209123456")]
    docs = spark.createDataFrame([(10 * i + j, x) for i, xs in enumerate(same) for j, x in enumerate(xs)], "doc_id long, text string")
    out = {r.doc_id: "+" + re.sub(r"\D", "", r.text) for r in P.pseudonymise(docs, "k").collect()}
    for i, (xs, code) in enumerate(zip(same, ("+1", "+44", "+353"))):
        assert len({out[10 * i + j] for j in range(len(xs))}) == 1 and out[10 * i].startswith(code)


def test_names_have_syllables_gender_and_shared_surnames(spark):
    texts = ["Mr Ivan Petrov met Mrs Anna Smith. Mr Petrov left with Mr Ivan Kuznetsov; Herr Карпов saw Frau Άννα", "Mr. IVAN PETROV"]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, found string, `row` int")
    out = P.pseudonymise(docs, "k").orderBy("doc_id").collect()
    m = re.fullmatch(r"Mr (\w{4}) (\w{6}) met Mrs (\w{4}) (\w{5})\. Mr (\w{6}) left with Mr (\w{4}) (\w{9}); Herr ([А-Я][а-я]{5}) saw Frau ([Α-Ω][α-ω]{3})", out[0].text)
    assert m and m[2] == m[5] != m[7] and m[1] == m[6] and m[3][-1] == m[4][-1] == "a" and m[9][-1] == "α"
    assert all(x[-1] not in "aeiouаеиоу" for x in (m[1], m[2], m[7], m[8])) and re.fullmatch("(?i)[^aeiou][aeiou][^aeiou][^aeiou]", m[1])
    assert out[1].text == f"Mr. {m[1].upper()} {m[2].upper()}" and (out[0].n_entities, out[0].found, out[0].row) == (6, "x", 1)


def test_a_thousand_short_names_stay_apart(spark):
    names = [f"Ms {a}{b}" for a in map(chr, [*range(65, 91), *range(0x410, 0x42A)]) for b in map(chr, [*range(97, 117)])]
    out = [r.text for r in P.pseudonymise(spark.createDataFrame(list(enumerate(names)), "doc_id long, text string"), "k").collect()]
    assert len(names) > 1000 and len({x.lower() for x in out}) == len({x.lower() for x in names}) and not {x.lower() for x in out} & {x.lower() for x in names}


def test_numbers_with_and_without_country_code_are_one(spark):
    docs = spark.createDataFrame([(1, "+1 (017) 555-7713"), (2, "(017) 555-7713"), (3, "+49 (017) 555-7713")], "doc_id long, text string")
    a, b, c = [r.text for r in P.pseudonymise(docs, "k").orderBy("doc_id").collect()]
    assert a == f"+1 {b}" and c == f"+49 {b}" and b != "(017) 555-7713"


def test_against_a_plain_surrogate_function(spark):
    """Cards and secrets by the definition: digits and hex digits of SHA-256 streams of key, type, canonical form, attempt."""
    import hashlib

    def stream(kind, canon):
        seed = "\x1f".join(["k", kind, canon, "0"])
        return "".join(hashlib.sha256(f"{seed}\x1f{i}".encode()).hexdigest() for i in range(16))

    def card(surface):
        digits = iter(stream("card", re.sub(r"\D", "", surface)).translate(str.maketrans("abcdef", "258147")))
        return "".join(next(digits) if c.isdigit() else c for c in surface)

    cards = [f"{4000 + i} {1000 + 7 * i} 5555 {9000 - i}" for i in range(200)]
    secrets = [hashlib.md5(str(i).encode()).hexdigest() for i in range(200)]
    docs = spark.createDataFrame([(i, f"{'pad ' * (20_000 if i == 3 else 1)}{c}, {s}!") for i, (c, s) in enumerate(zip(cards, secrets))] * 2, "doc_id long, text string")
    got = P.pseudonymise(docs, "k").collect()
    assert len(got) == 400
    for r in got:
        assert r.text.endswith(f"pad {card(cards[r.doc_id])}, {stream('secret', secrets[r.doc_id])[:32]}!")
