import hashlib
import math
import random
import re
from collections import defaultdict

from loanscope.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def valid(kind, m):
    digits = re.sub(r"\D", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute(text):
    found = [(m.start(), k, m.end()) for k, kind in enumerate(PATTERNS) for m in re.finditer(PATTERNS[kind], text) if valid(kind, m.group())]
    return ",".join(f"{list(PATTERNS)[k]}:{s}:{e}" for s, k, e in sorted(found))


def run(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in pii.pii_digest(pii.pii_spans(df, **more)).collect()}


def test_base_spans_against_brute_force(spark):
    parts = ["a@b.c", "a@b.c_x@y.z", "@", "x.y+z@host-1.example.org", "..", "1.2.3.4", "1.2.3.4.5", "256.1.1.1", "0000255.1.1.01", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "378282246310005", "+1 (555) 123-4567", "+1", "+44 20 7946 0958 12 99 00", "12345678901234567890", " ", "é😀", "-", "(", "+", "9", "\n",
             "a@b.c@d.e", "%%@x.", "7-7-7", "0" * 12]
    rng = random.Random(5)
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "x", ","]) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    rows = run(spark, texts)
    for i, t in enumerate(texts):
        want = brute(t)
        assert ",".join(s for s in rows[i]["spans"].split(",") if not s.startswith("term")) == want, t
        assert rows[i]["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in PATTERNS] == [want.count(f"{k}:") for k in PATTERNS]


def test_long_runs_take_linear_time(spark):
    long = "a" * 200_000 + " " + "1." * 50_000 + " " + "9" * 100_000 + " a@b" + ".c" * 50_000 + " +1" + " (" * 50_000
    rows = run(spark, [long, long + "!"])
    for r in rows.values():
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 12_500, 0, 0)


def test_disclosing_terms(spark):
    filler = ["the weather in town was fine today and nobody minded", "many people like the sea and the hills"]
    texts = [f"{filler[i % 2]} number {i}" for i in range(60)]
    # Distinct surroundings share the rare Quixotl; "the" is near too, but common everywhere.
    texts += [f"the{x} Quixotl the zed@example.org {y}" for x, y in (("", "wrote"), ("n", "said"), ("", "called"), ("se", "went"))]
    rows = run(spark, texts)
    told = {i: r["spans"] for i, r in rows.items() if r["n_terms"]}
    assert set(told) == {60, 61, 62, 63}
    assert told[60] == "term:4:11,email:16:31"
    spotted = pii.sanitise(pii.pii_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    clean = {r["doc_id"]: r["clean"] for r in spotted.collect()}
    assert clean[60] == "the  the <email> wrote" and clean[0] == texts[0]
    # Copies count once, and a single meeting among 61 texts can be chance.
    assert not any(r["n_terms"] for r in run(spark, texts[:60] + [texts[60]] * 6).values())
    # Between the thresholds a term keeps its shape.
    soft = pii.sanitise(pii.pii_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), remove=2.0))
    assert {r["doc_id"]: r["clean"] for r in soft.collect()}[60] == "the Aaaaaaa the <email> wrote"


def test_an_identifier_seen_once_takes_part(spark):
    texts = [f"please call the office at noon or write to them, note {i}" for i in range(400)] + ["please write to Quixotl at zed@example.org, note"]
    rows = run(spark, texts)
    assert {i: r["spans"] for i, r in rows.items() if r["n_terms"]} == {400: "term:16:23,email:27:42"}
    spotted = pii.sanitise(pii.pii_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert {r["doc_id"]: r["clean"] for r in spotted.collect()}[400] == "please write to  at <email>, note"


def test_copies_count_once_in_all_counts(spark):
    texts = [f"please call the office at noon or write to them, note {i}" for i in range(400)]
    held = [f"please write to Quixotl at zed@example.org, note {i}" for i in range(3)]
    once = run(spark, texts + held)
    # 60 copies each: in documents, n(t) would be 180 against n(c) = n(c, t) = 3.
    many = run(spark, texts + held * 60)
    assert once[400]["spans"] == "term:16:23,email:27:42"
    assert {r["spans"] for i, r in many.items() if i >= 400} == {r["spans"] for i, r in once.items() if i >= 400}


def test_terms_of_the_whole_document(spark):
    filler = "please call the office at noon or write to them, as one can say in many words, note"
    texts = [f"{filler} {i}" for i in range(400)]
    # Four words away, on the next line, twice, and beyond another identifier.
    texts += [f"Quixotl can say please write to them at zed@example.org\nor call quixotl, 1.2.3.4 and Quixotl {i}" for i in range(2)]
    texts += ["zed@example.org, call at noon", "quixotl in the office"]
    rows = run(spark, texts)
    for i in (400, 401):
        places = [m.start() for m in re.finditer("quixotl", texts[i].lower())]
        assert [p for p in places if f"term:{p}:{p + 7}" in rows[i]["spans"].split(",")] == places
    assert not rows[402]["n_terms"] and not rows[403]["n_terms"]


def test_long_words_stay_whole(spark):
    filler = [f"please write to them at noon, note {i}" for i in range(400)]
    long = "x" * 700
    rows = run(spark, [*filler, f"please write {long} zed@example.org", f"at noon a@b.org {long}y", f"at noon {'.' * 600} {long}z {'.' * 600} c@d.org"])
    assert rows[400]["spans"] == "term:13:713,email:714:729"
    assert rows[401]["spans"] == "email:8:15,term:16:717"
    assert rows[402]["spans"] == "term:609:1310,email:1912:1919"


def brute_terms(texts, all_pairs=False, generalise=pii.GENERALISE, confidence=pii.CONFIDENCE):
    """Per text the places of marked terms: every identifier against every term, in plain Python."""
    spans, said, held, having, meets = {}, {}, defaultdict(set), defaultdict(set), defaultdict(set)
    for text in set(texts):
        spans[text] = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in brute(text).split(",") if x)]
        blank = list(text)
        for s, e, _ in spans[text]:
            blank[s:e] = " " * (e - s)
        said[text] = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", "".join(blank))]
        values = {(k, text[s:e].lower() if k == "email" else re.sub(r"[ ().+-]", "", text[s:e])) for s, e, k in spans[text]}
        for c in values:
            held[c].add(text)
        for t, _, _ in said[text]:
            having[t].add(text)
            for c in values:
                meets[c, t].add(text)
    n = len(spans)
    fits = lambda c, t: len(having[t]) <= n ** (1 - generalise) * len(held[c]) ** generalise * (1 + 1e-9)
    tested = sum(fits(c, t) for c, t in meets) if all_pairs else 1
    telling = set()
    for (c, t), both in meets.items():
        nc, nt, nct = len(held[c]), len(having[t]), len(both)
        pmi, ic = math.log2(nct / nc * n / nt), math.log2(n / nc)
        if ic > 0 and pmi / ic >= generalise and nct * (pmi * math.log(2) - 1) + nc * nt / n >= -math.log((1 - confidence) / tested):
            telling |= {(text, t) for text in both}
    return [[f"term:{s}:{e}" for t, s, e in said[text] if (text, t) in telling] for text in texts], sum(fits(c, t) for c, t in meets)


def corpus_of_notes():
    rng = random.Random(11)
    words, people = [f"w{i}" for i in range(300)], [f"p{i}@x.org" for i in range(12)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(500)]
    for i in range(60):
        who = rng.sample(range(12), rng.choice([1, 1, 2, 3]))
        texts.append(" ".join([*rng.choices(words, k=6), *(f"secret{j} {people[j]}" for j in who), f"only{i}", "1.2.3.4" if i % 7 == 0 else ""]))
    return texts + texts[-20:]


def test_terms_against_brute_force(spark):
    texts = corpus_of_notes()
    for all_pairs in (False, True):
        want, _ = brute_terms(texts, all_pairs)
        rows = run(spark, texts, all_pairs=all_pairs)
        got = [[s for s in rows[i]["spans"].split(",") if s.startswith("term")] for i in range(len(texts))]
        assert got == want
        assert sum(map(len, want)) > 50
    # All pairs counted, words seen once are no evidence; the repeated ones still go.
    marked = {texts[i][int(s.split(":")[1]):int(s.split(":")[2])] for i, spans in enumerate(want) for s in spans}
    assert any(m.startswith("secret") for m in marked) and not any(m.startswith("only") for m in marked)


def test_a_page_of_addresses_is_not_quadratic(spark, monkeypatch):
    filler = [f"please call the office at noon or write to them, note {i}" for i in range(400)]
    page = " ".join(f"a{i}@x.org" for i in range(300)) + " " + " ".join(f"word{i}" for i in range(2000))
    shared = [f"a{i}@x.org a{i + 1}@x.org please and word{i}" for i in range(0, 40, 2)]
    texts = [*filler, page, *shared]
    sizes, land = {}, pii.land

    def counted(df, name):
        out = land(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(pii, "land", counted)
    monkeypatch.setattr(pii, "PART", 8)  # the page's terms are dealt over parts
    rows = run(spark, texts)
    want, tested = brute_terms(texts)
    assert tested > 500_000 and sizes["pii-pairs"] < 2_000
    for i in range(400, len(texts)):
        assert [s for s in rows[i]["spans"].split(",") if s.startswith("term")] == want[i]
