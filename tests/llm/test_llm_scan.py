import ipaddress
import random
import re

from flowlake.llm import secret_scan, surrogates
from flowlake.llm.queries_scan import op2_surrogates

DOCS = "doc_id long, text string, spans string, trigram int, entities string"
KEY = b"test"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOCS)


def brute_spans(text):
    rules = [("assign", re.compile(secret_scan.RULES[0].pattern, re.A), 2, 6), ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
             ("hex", re.compile(r"[0-9a-f]+"), 0, 24)]
    rules += [(r.kind, re.compile(r.pattern), r.group, r.least) for r in secret_scan.RULES[3:]]
    order = [r[0] for r in rules]
    found = [(m.start(), order.index(k), m.end(), k) for k, p, g, least in rules for m in p.finditer(text or "") if len(m[g]) >= least]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def test_spans_against_a_plain_scan(spark):
    rng = random.Random(3)
    atoms = ["password", "PassWd", "token", "api_key", "APIKEY", "Secret", "=", ":", " ", '"', "'", "abc", "abcdef", "AKIA", "AKIA" + "Z9" * 9,
             "deadbeef" * 3, "0" * 23, "é", "\n", "😀", "x", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 20, "xoxb-" + "1a-" * 5,
             "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12]
    rows = [(i, "".join(rng.choice(atoms) for _ in range(rng.randrange(25)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "token=abcdefg"), (202, ("word " * 40_000) + "secret: hunter22"), rows[3], (3, "other text, same id token:123456")]
    got = secret_scan.scan(documents(spark, rows), keep=["doc_id", "text"])
    for row in got.collect():
        assert [tuple(s) for s in row.spans] == brute_spans(row.text), row.text
    assert got.count() == len(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert secret_scan.scan(documents(spark, [])).count() == 0


def test_trigram_queries_are_necessary():
    assert secret_scan.trigram_query("[0-9a-f]{24,}") == [frozenset()]
    assert secret_scan.trigram_query("AKIA[A-Z0-9]{16,}") == [frozenset({"aki", "kia"})]
    assert set(secret_scan.trigram_query("abc(def|gh)?ij+k")) == {
        frozenset({"abc", "bcd", "cde", "def", "efi"}), frozenset({"abc", "bcg", "cgh", "ghi"}), frozenset({"abc", "bci"})}
    samples = {"assign": ["passwd=abcdef", 'API_KEY": "abcdef', "apikey:abcdef", "toKen = abcdef"], "chat_token": ["xoxp-0123456789"], "forge_token": ["ghs_" + "a" * 36]}
    for rule in secret_scan.RULES:
        for text in samples.get(rule.kind, ()):
            assert any(all(t in text.lower() for t in a) for a in secret_scan.trigram_query(rule.pattern))


def test_rules_without_trigrams_only(spark):
    rules = (secret_scan.Rule("hex", "[0-9a-f]{4,}"),)
    rows = secret_scan.scan(documents(spark, [(1, "xx beef yy"), (2, None)]), rules).collect()
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in rows} == {1: [("hex", 3, 7)], 2: []}


PERSONAL = """Mrs. Anna Bell (anna.bell@mail.example.org, ANNA.BELL@mail.example.org) and MR JOHN SMITH, Frau Müller-Lang.
Call +1 (229) 555-4838 or 1 229 555 4838 from 10.20.30.40; card 4539 1488 0343 6467, 4539148803436467; 078-05-1120;
DE89 3704 0044 0532 0130 00; г-жа Иванова; господин Петров; Mrs Anna Bell again."""


def test_surrogates_keep_kind_shape_and_identity(spark):
    row = surrogates.replace_entities(documents(spark, [(1, PERSONAL)]), KEY).first()
    old = [(k, PERSONAL[s:e]) for k, s, e in surrogates.mentions(PERSONAL)]
    new = [(x.kind, row.new_text[x.start:x.end]) for x in row.entities]
    assert [k for k, _ in old] == [k for k, _ in new] == [k for k, _, _ in surrogates.mentions(row.new_text)]
    mapping = {}
    for (kind, a), (_, b) in zip(old, new):
        assert a not in row.new_text
        assert mapping.setdefault((kind, surrogates.canonical(kind, a)), surrogates.canonical(kind, b)) == surrogates.canonical(kind, b)
        if not kind.startswith("name"):
            assert kind == "ip" or re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", a)).replace("A", "a") == re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", b))
    assert len(set(mapping.values())) == len(mapping)
    cards = [b for (k, _), (_, b) in zip(old, new) if k == "card"]
    assert len(cards) == 2 and all(surrogates._luhn(re.sub(r"\D", "", c)) == 0 for c in cards)
    names = [b for (k, _), (_, b) in zip(old, new) if k.startswith("name")]
    assert names[1].isupper() and all("а" <= c.lower() <= "я" for c in names[3] + names[4])
    outside = lambda text, found: re.sub(r"\s+", " ", "|".join(text[e:s] for e, s in found))
    gaps = lambda places: list(zip([0, *(e for _, e in places)], [*(s for s, _ in places), None]))
    assert outside(PERSONAL, gaps([(s, e) for _, s, e in surrogates.mentions(PERSONAL)])) == outside(row.new_text, gaps([(x.start, x.end) for x in row.entities]))


def test_collisions_are_redrawn(spark, monkeypatch):
    # Short addresses leave few surrogates, so first draws collide.
    rng = random.Random(2)
    entities = {f"{a}.{b}.{c}.{d}" for a, b, c, d in (rng.sample(range(1, 10), 4) for _ in range(700))}
    rows = [(i, f"from {e} to {e}.") for i, e in enumerate(sorted(entities))] + [(9000, None), (None, "1.2.3.4"), (9001, ""), (5, "1.2.3.5 or 1.2.3.4")]
    changed = surrogates.redrawn_entities(documents(spark, rows), KEY)
    assert changed.count() > 0
    out = surrogates.replace_entities(documents(spark, rows), KEY, keep=["doc_id", "text"]).collect()
    mapping = {}
    for r in out:
        for (k, s, e), x in zip(surrogates.mentions(r.text), r.entities):
            new = r.new_text[x.start:x.end]
            assert mapping.setdefault(r.text[s:e], new) == new
    assert len(set(mapping.values())) == len(mapping) and not set(mapping.values()) & set(mapping)
    assert len(out) == len(rows)


def spans(text):
    return [(k, text[s:e]) for k, s, e in surrogates.mentions(text)]


def test_common_forms_of_numbers_are_found():
    for phone in ("+14155550123", "+442079460958", "+33 1 23 45 67 89", "01 23 45 67 89", "+41 44 668 18 00", "+91 98765 43210", "+44 (20) 7946 0958"):
        assert spans(f"Call {phone}, or not.") == [("phone", phone)]
    for card in ("378282246310005", "3782 822463 10005", "4222222222222", "4539148803436467", "6304 0000 0000 0000 000", "30569309025904"):
        assert spans(f"paid by {card}.") == [("card", card)]
    assert spans("+14155550123 4539 1488 0343 6467") == [("phone", "+14155550123"), ("card", "4539 1488 0343 6467")]
    assert spans("+33 1 23 45 67 89 4539 1488 0343 6467") == [("phone", "+33 1 23 45 67 89"), ("card", "4539 1488 0343 6467")]
    for address in ("2001:db8:85a3::8a2e:370:7334", "2001:0DB8:0000:0000:0000:FF00:0042:8329", "fe80::1"):
        assert spans(f"from {address} on") == [("ip6", address)]
    assert spans("at 12:30:45, std::map, a::b, x[1::2], ::1 and 1234567890123") == []
    assert spans("at ::ffff:10.20.30.40") == [("ip", "10.20.30.40")]
    assert spans("Тел. ٠١٢-٣٤٥-٦٧٨٩") == [("phone", "٠١٢-٣٤٥-٦٧٨٩")]
    assert surrogates.mentions("+" + "1 " * 50_000) is not None and surrogates.mentions("1234 " * 20_000) is not None


def test_bare_mentions_of_names_agree(spark):
    text = "Smith wrote. Mr John Smith The Elder met Mrs Anna Bell. John Smith and SMITH said that the bell rang; Anna agreed, Bell Smithson too, john."
    rows = [(1, text), (2, "Mr Smith again"), (3, "Smith alone"), (4, "fe80::1 and FE80:0:0:0:0:0:0:1 and +14155550123")]
    got = {r.doc_id: r for r in surrogates.replace_entities(documents(spark, rows), KEY).collect()}
    new = got[1].new_text
    assert not re.search(r"\b(John|Smith|SMITH|Anna)\b", new) and "Bell Smithson too, john." in new and " the bell rang" in new
    full = re.search(r"Mr (\w+) (\w+)", new)
    smith, john = full[2], full[1]
    assert new.startswith(f"{smith} wrote.") and f" {john} {smith} and {smith.upper()} said" in new
    assert got[2].new_text == f"Mr {smith} again" and got[3].new_text == "Smith alone"
    first, second = got[4].new_text.split(" and ")[:2]
    assert ipaddress.ip_address(first) == ipaddress.ip_address(second) != ipaddress.ip_address("fe80::1")
    assert [x.kind for x in got[4].entities] == ["ip6", "ip6", "phone"]


def test_surrogates_of_nothing(spark):
    assert surrogates.replace_entities(documents(spark, []), KEY).count() == 0
    got = {r.doc_id: (r.new_text, r.entities) for r in surrogates.replace_entities(documents(spark, [(1, None), (2, ""), (3, "plain")]), KEY).collect()}
    assert got == {1: (None, []), 2: ("", []), 3: ("plain", [])}


def test_no_entity_of_the_table_is_left(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op2_surrogates(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    real = {(k, surrogates.canonical(k, t[s:e])) for t in docs.values() for k, s, e in surrogates.mentions(t)}
    for r in rows:
        left = {(k, surrogates.canonical(k, r.text[s:e])) for k, s, e in surrogates.mentions(r.text)}
        assert not left & real and r.n_entities == len(surrogates.mentions(docs[r.doc_id]))
