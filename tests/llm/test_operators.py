"""Text operators on the awkward cases and against brute force."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, chat, fingerprints, html, minhash, mixing, pii, quality, secrets, suffix_dedup
from tessera.llm.queries import tokenizer_path

from .conftest import AWKWARD, DOCS

PATH = tokenizer_path()
RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choices("abcdefghij", k=RNG.randint(2, 6))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


OPERATORS = {
    "pii": lambda d: pii.detect(d, ["doc_id"]),
    "redact": pii.redact,
    "mixing": mixing.sample,
    "repeats": suffix_dedup.remove_repeats,
    "bpe": lambda d: bpe.encode(d, PATH),
    "quality": quality.judge,
    "keep_good": quality.keep_good,
    "minhash": minhash.near_duplicates,
    "secrets": lambda d: secrets.detect(d, ["doc_id"]),
    "fingerprints": fingerprints.fingerprint_edits,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_and_clashing_columns(name, awkward):
    extra = awkward.withColumns({c: F.lit("x") for c in ("id", "n", "found", "spans", "kept", "text2", "range", "key", "band", "t", "k")})
    rows = OPERATORS[name](extra).collect()
    if name != "keep_good":
        assert len(rows) == len(AWKWARD)
        assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter(r[0] for r in AWKWARD)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, spark):
    assert OPERATORS[name](spark.createDataFrame([], DOCS)).count() == 0


def test_bpe_equals_library_and_decodes(docs):
    from tokenizers import Tokenizer
    ref = Tokenizer.from_file(PATH)
    r = random.Random(2)
    pool = [chr(c) for c in [*range(0x250), 0x3A3, 0x130, 0x301, 0x1C, 0x85, 0x2003, 0x4E2D, 0x1F600, 0xFB01, 0x1E9E]]
    texts = ["".join(r.choices(pool, k=r.randint(0, 60))) for _ in range(300)]
    texts += ["<|startoftext|> it's <|endoftext|><|", "a" * 3000, "", prose(300, 1).upper()]
    got = bpe.encode(docs(list(enumerate(texts))), PATH)
    again = {x["doc_id"]: x["decoded"] for x in bpe.decode(got, PATH).collect()}
    for row in got.collect():
        ids = ref.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert [int.from_bytes(row["ids"][i:i + 4], "little") for i in range(0, len(row["ids"]), 4)] == ids
        assert row["n_tokens"] == len(ids)
        assert row["decoded"] == again[row["doc_id"]] == ref.decode(ids, skip_special_tokens=False)


def brute_repeats(texts, n=100):
    seen, out = set(), {}
    for i in sorted(texts):
        b, gone = texts[i].encode(), set()
        for p in range(len(b) - n + 1):
            if b[p:p + n] in seen:
                gone.update(range(p, p + n))
            seen.add(b[p:p + n])
        out[i] = (len(gone), bytes(c for q, c in enumerate(b) if q not in gone))
    return out


def test_repeats_equal_brute_force(docs):
    a, b = prose(120, 3), prose(90, 4)
    texts = {0: a, 1: prose(30, 5) + b + prose(20, 6), 2: a, 3: "zz " + a[50:400] + " yy " + a[10:220] + "é" * 90, 4: b[:99], 5: b[7:107],
             6: "word " * 200, 7: "x" * 350, 8: "word " * 60 + b[100:330], 9: a[:150] + "!" + a[151:], 10: "", 11: (b + "\n") * 3}
    rows = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs(list(texts.items()))).collect()}
    for i, (n, kept) in brute_repeats(texts).items():
        assert (rows[i]["n_removed"], bytes(rows[i]["kept"])) == (n, kept), i


def test_intervals_and_left_extensions():
    assert list(suffix_dedup.intervals([2, 2, 0, 3])) == [(2, 0, 2), (3, 3, 4), (0, 0, 4)]
    group = [(b"a" * 60 + b"x", b"qrs" * 20, 1, 5), (b"a" * 60 + b"y", b"qrs" * 20, 2, 5), (b"a" * 60 + b"z", b"q" * 60, 3, 5)]
    assert list(suffix_dedup.maximal_repeats(group, 100)) == [(60, 60, [0, 1])]


def test_near_duplicates_equal_brute_force(docs):
    texts = {i: prose(60, i) for i in range(40)}
    r = random.Random(8)
    for i in range(40, 120):
        w = texts[i % 7].split()
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = r.choice(VOCABULARY)
        texts[i] = " ".join(w).upper() if i % 5 == 0 else " \t".join(w)
    sets = {i: frozenset(zip(*(t.lower().split()[k:] for k in range(3)))) for i, t in texts.items()}
    least = {i: i for i in texts}
    for _ in range(10):
        for i in texts:
            for j in texts:
                if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    least[i] = least[j] = min(least[i], least[j])
    got = minhash.near_duplicates(docs(list(texts.items())), size=3, percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == least
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (least[r["doc_id"]] == r["doc_id"]) for r in got)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (102, 101)], "a bigint, b bigint")
    assert {r["id"]: r["comp"] for r in minhash.components(edges).collect()} == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100}


def test_fingerprints_estimate_generalised_jaccard(docs):
    texts = {i: prose(200, i) for i in range(30)} | {30: prose(200, 3)}
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(docs(list(texts.items()))).collect()}
    bags = {i: collections.Counter(t.split()) for i, t in texts.items()}
    assert got[3]["fingerprint"] == got[30]["fingerprint"] != got[4]["fingerprint"]
    errors = []
    for i, t in texts.items():
        after = texts[(i + 1) % 31]
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        other = collections.Counter(edited.split())
        errors.append(got[i]["near_edited"] - (bags[i] & other).total() / (bags[i] | other).total())
        assert got[i]["near_edited"] > got[i]["near_next"]
    assert abs(sum(errors) / 31) < 0.04 and max(map(abs, errors)) < 0.35


def test_pii_base_rules_equal_the_patterns():
    r = random.Random(3)
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and pii.luhn(re.sub("[^0-9]", "", m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15)]
    for _ in range(3000):
        t = "".join(r.choices("ab@@..--12  +()_%4", k=r.randint(3, 60)))
        want = sorted((m.start(), i, m.end(), k) for i, (k, p, ok) in enumerate(rules) for m in re.finditer(p, t) if ok(m[0]))
        assert pii.base_spans(t) == [(s, e, k) for s, _, e, k in want], t


def test_weak_supervision_finds_and_redacts(docs):
    rows = [(i, f"{prose(20, i)} call phone 415-555-{1000 + i} or mail jo.doe{i} [at] example [dot] com about it {prose(9, i)}") for i in range(30)]
    rows += [(100 + i, prose(40, 200 + i) + " 111-111-1111") for i in range(5)]
    table = docs(rows)
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.detect(table, ["doc_id"]).collect()}
    assert all(got[i] == ["local_phone", "email_words"] for i in range(30))
    assert all(not got[100 + i] for i in range(5))
    clean = {r["doc_id"]: r["text"] for r in pii.redact(table).collect()}
    assert "[LOCAL_PHONE]" in clean[0] and "555" not in clean[0] and clean[100] == rows[30][1]


def test_secrets_by_format(docs):
    r = random.Random(4)
    key = lambda n: "".join(r.choices("0123456789abcdef", k=n))
    rows = [(i, f"{prose(10, i)} token = \"{key(40)}\" {prose(5, i)}") for i in range(60)]
    rows += [(100, f"{prose(10, 1)} {key(22)} end"), (101, prose(30, 2) + " International-Telecommunication-Union internationalisation")]
    got = {x["doc_id"]: [(s["kind"], s["stop"] - s["start"]) for s in x["spans"]] for x in secrets.detect(docs(rows), ["doc_id"]).collect()}
    assert all([k for k, _ in got[i]] == ["assign", "hex"] for i in range(60))
    assert got[101] == []


def test_grammar_merges_states_and_tells_formats_apart():
    r = random.Random(4)
    words = ["".join(r.choices("dh", k=r.randint(20, 40))) for _ in range(300)]
    found = secrets.Automaton(words)
    assert found.score("dhdhdhhddhhdhdhdhdhdhhd") > found.score("lllUllllllUlll-lllllllll")


def test_quotation_links(spark):
    rows = [("c", 0, "user", "Shall we meet on Monday?\nI am free all day."),
            ("c", 1, "bot", "On Friday user wrote:\n> Shall we  meet on MONDAY?\n\nYes, at ten."),
            ("c", 2, "user", ">> Shall we meet on Monday?\n> Yes, at ten.\nGood."),
            ("c", 3, "user", "Something else"), ("d", 4, "user", "> Yes, at ten.\nnot here"), (None, None, None, None), ("c", 5, "x", "")]
    got = {(r["conv_id"], r["turn"]): r for r in chat.link(spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string")).collect()}
    assert len(got) == len(rows)
    row = got["c", 2]
    assert (row["parent_turn"], row["thread_turn"], row["depth"], row["n_quoted"], row["quote_depth"], row["own_text"]) == (1, 0, 2, 2, 2, "Good.")
    assert (got["c", 1]["parent_turn"], got["c", 1]["own_text"]) == (0, "Yes, at ten.")
    assert got["d", 4]["parent_turn"] is None and got["c", 3]["thread_turn"] == 3


def test_main_text(spark):
    page = """<html><head><title>T</title><script>x("<p>no</p>")</script></head><body><nav><a href=1>Menu</a></nav>
    <div class="cookie-notice">We use cookies for all that you do here</div><main><h1>Title &amp; more</h1><p>Short.<p>One  <b>two</b>
    three&nbsp;four <a href=x>five</a>.</p><aside>aside text</aside></main><div id="comments"><p>I say so too.</p></div><footer>&copy; me</footer></body></html>"""
    table = spark.createDataFrame([(1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "word " * 30 + "<p>unclosed")], "page_id bigint, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(table).collect()}
    assert got[1] == "Title & more\n\nShort.\n\nOne two three four five."
    assert got[2] == got[None] == "" and got[3].startswith("word word")
    assert html.extract(table.where("page_id > 9")).count() == 0


def test_hosts_are_judged(docs):
    bad = [(i, (prose(30, i) + " ###***$$$%%%&&&||| ") * 1 + "#" * 60, "en", "bad") for i in range(40)]
    good = [(100 + 50 * h + i, prose(60, 900 + 50 * h + i), "en", f"good{h}") for h in range(4) for i in range(40)]
    lone = [(1000, prose(30, 1) + "#" * 60, "en", "good1"), (1001, prose(60, 77), "en", "bad")]
    got = {r["doc_id"]: r for r in quality.judge(docs(bad + good + lone)).collect()}
    assert not got[0]["kept"] and got[0]["host_strict"] == "symbols"
    assert got[1000]["kept"] and got[1001]["kept"] and got[100]["kept"]


def test_mixing_reaches_its_targets(docs):
    rows = [(i, prose(20 + i % 30, i), "en" if i % 4 else "de", f"s{min(3, i % 9)}") for i in range(600)]
    table = docs(rows)
    fitted = mixing.rake(mixing.flattened(mixing.cells(table)), {m: F.col(f"t_{m}") for m in mixing.MARGINS}).toPandas()
    for m in mixing.MARGINS:
        sums = fitted.groupby(m).agg({"w": "sum", f"t_{m}": "first"})
        assert (sums["w"] - sums[f"t_{m}"]).abs().max() < 1e-6
    got = mixing.sample(table).toPandas()
    assert len(got) == 600 and got["mix_p"].max() == pytest.approx(1)
    assert got["mix_kept"].sum() == pytest.approx(got["mix_p"].sum(), rel=0.1)
