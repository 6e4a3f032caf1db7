"""Personal data: base spans against the plain patterns, bootstrap on planted contexts, masking."""

import hashlib
import re

from cases import ROWS, documents, empty
from chanlytics.llm import common as C
from chanlytics.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
TEXTS = ["a@b.co, x.y@z-1.example.org a@b @c.d e@f.g.h@i.j", "1.2.3.4 256.1.1.1 0001.2.3.255 1.2.3.4.5.6.7.8 999.9.9",
         "4111111111111111 4111-1111-1111-1111 4111 1111 1111 1111 4111111111111112 12345678901234567890",
         "+1 (017) 555-7713 +12 +1-800-555-0199. ++49 30 1234567 +123456789012345678", "é🙂 mail: ü.é@x.y 日本 1.1.1.1 end",
         "a@b.c_x@d.e", "7" * 3000, "1." * 500 + "1", "a" * 5000 + "@x.y", "x@" * 400, "+1" * 300, "tel +1 202 555 01 99\n+1 202 555 01 98",
         "000001.000255.3.04", "1.2.3.99999999999999999999", "0" * 16, "5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 5"]
MORE = ROWS + [(100 + i, t) for i, t in enumerate(TEXTS)]


def luhn(digits):
    value = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        value += d if i % 2 == 0 else d * 2 - 9 if d > 4 else d * 2
    return value % 10 == 0


def accepted(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if accepted(k, m.group())]


def test_base_spans(spark):
    C.prepare(spark)
    got = pii.report(documents(spark, MORE)).collect()
    want = []
    for i, t in MORE:
        spans = base(t)
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want.append((str(i), *(sum(k == kind for k, _, _ in spans) for kind in pii.KINDS),
                     hashlib.sha256(said.encode()).hexdigest(), said))
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in got) == sorted(want)


def planted():
    """A context that precedes phone numbers, and strings in it that no base pattern accepts."""
    rows = [(i, f"please reach me at +1 (202) 555-{1000 + i} today") for i in range(60)]
    rows += [(100, "Reach ME at (202) 555-7777 or write"), (101, "please reach me at 202-555-8888"),
             # learnt in the first round, elsewhere in no good context; it gives a second context its support
             (102, "fax to 202-555-8888 soon"), (103, "order number 202-555-9999 was shipped")]
    # a context in which most strings are not personal
    rows += [(200 + i, f"part number {2020000 + i}-{i:03d} and") for i in range(30)] + [(300, "part number +1 202 555 0000 and")]
    return rows


def test_bootstrap_finds_strings_in_learnt_contexts(spark):
    C.prepare(spark)
    rows = planted()
    found = {r.doc_id: r for r in pii.find(documents(spark, rows)).collect()}
    text = dict(rows)
    added = {i: [text[i][s.start:s.end] for s in r.spans if s not in r.base] for i, r in found.items()}
    assert {i: a for i, a in added.items() if a} == {
        100: ["(202) 555-7777"], 101: ["202-555-8888"], 102: ["202-555-8888"]}
    for i, t in rows:
        assert [(s.kind, s.start, s.end) for s in found[i].base] == base(t)


def test_contexts_with_some_unknown_strings_are_learnt(spark):
    """18 seeds and one local number before or after the same words; numbers that fail the checksum stay out."""
    C.prepare(spark)
    rows = [(i, f"k{i} call me at +1 202 555 {1000 + i} x{i} y") for i in range(18)] + [(50, "now call me at 202 555 7777")]
    rows += [(100 + i, f"q{i} z{i} +49 30 55{1000 + i} office hours only") for i in range(18)] + [(150, "v w 030 551 7777 office hours")]
    good = [f"{x:016d}" for x in range(4111111111110000, 4111111111110600) if luhn(f"{x:016d}")][:10]
    bad = [f"{x:016d}" for x in range(4111111111120000, 4111111111120600) if not luhn(f"{x:016d}")][:10]
    rows += [(200 + i, f"order number {n} was sent") for i, n in enumerate(good + bad)]
    text = dict(rows)
    found = {r.doc_id: [text[r.doc_id][s.start:s.end] for s in r.spans if s not in r.base]
             for r in pii.find(documents(spark, rows)).collect()}
    assert {i: a for i, a in found.items() if a} == {50: ["202 555 7777"], 150: ["030 551 7777"]}


def test_masking(spark):
    C.prepare(spark)
    rows = planted() + MORE
    df = documents(spark, rows)
    got = pii.mask(df)
    assert got.columns == df.columns

    def masked(text):
        out, at = "", 0
        for a, b, k in sorted((a, b, k) for k, a, b in base(text)):
            if a >= at:
                out += text[at:a] + f"<{k}>"
            at = max(at, b)
        return out + text[at:]

    texts = [(str(r.doc_id), r.text) for r in got.collect()]
    plain = [(i, t) for i, t in rows if i not in (100, 101, 102)]
    for i, t in plain:
        assert (str(i), None if t is None else masked(t)) in texts
    assert ("100", "Reach ME at <phone> or write") in texts and len(texts) == len(rows)


def test_empty_table(spark):
    C.prepare(spark)
    assert pii.report(empty(spark)).collect() == [] and pii.mask(empty(spark)).collect() == []
