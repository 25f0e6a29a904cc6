import hashlib
import re

from hypothesis import given, settings, strategies as st

from opskit.llm import disclosure

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c) * 2 if i % 2 else int(c)
        total += d if d < 10 else d - 9
    return total % 10 == 0


def plain(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                found.append((m.start(), rank, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(found)]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="01259.-+@ ()ab_é", max_size=60))
def test_base_spans_are_the_leftmost_matches(text):
    assert disclosure.base_spans(text) == plain(text)


def test_hard_texts():
    for text in ["a@b.c-d@e.f", "a@b.c_d@e.f.g", "@@a@b..c@d.e", "1.2.3.4.5.6.7.8", "0001.2.3.256", "4111 1111-1111 1111 x 4111111111111111", "+1 (456) 555-2186.", "x" * 50_000 + "@y.z", "1" * 50_000]:
        assert disclosure.base_spans(text) == plain(text)


def corpus(prose):
    rows = [(i, prose(i, 40, 300)) for i in range(60)]
    hint = "zeppelinfan"
    for i in range(8):  # the hint never occurs without the address, in contexts of its own
        rows.append((100 + i, f"{prose(200 + i, 20)} {hint} is at Bob@mail.example.com {prose(300 + i, 20)}"))
    copy = f"{prose(400, 10)} copiedonly carol@mail.example.com {prose(401, 10)}"
    rows += [(200 + i, copy) for i in range(12)]
    rows += [(300, None), (301, ""), (302, f"met {hint} today"), (303, "+1 (456) 555-2186 é 4111111111111111"), (None, "x@y.z"), (303, "+1 (456) 555-2186 é 4111111111111111")]
    return rows


def test_terms_that_reveal_an_entity_are_found(docs, prose):
    rows = corpus(prose)
    got = disclosure.report(docs(rows)).collect()
    assert len(got) == len(rows)
    texts = {}
    for d, t in rows:
        texts.setdefault(d, t or "")
    for r in got:
        text = texts[r.doc_id]
        want = plain(text)
        joined = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, _, k in want) for x in PATTERNS)
        added = [s.split(":") for s in r.spans.split(",") if s and s.split(":")[0] not in PATTERNS]
        found = {text[int(a) : int(b)] for _, a, b in added}
        assert found == ({"zeppelinfan"} if "zeppelinfan" in text else set())
        assert [s for s in r.spans.split(",") if s.split(":")[0] in PATTERNS] == [s for s in joined.split(",") if s]


def test_sanitised_texts(docs, prose):
    out = {r.doc_id: r.text for r in disclosure.sanitise(docs(corpus(prose))).collect()}
    assert out[303] == "[PHONE] é [CARD]" and out[300] is None
    assert "zeppelinfan" not in out[302] and "[EMAIL]" in out[100] and "copiedonly" in out[200]
    assert disclosure.report(docs([])).count() == 0


def test_entities_with_two_contexts_short_names_and_numbers(docs, prose):
    rows = [(i, f"The report. {prose(i, 40, 300)}") for i in range(60)]
    for i in range(2):
        rows.append((100 + i, f"{prose(200 + i, 20, 10**9)} quokkaclub dora@mail.example.com The {prose(300 + i, 20, 10**9)}"))
    for i in range(4):  # between other words, so that all contexts differ
        own = [prose(400 + 10 * i + k, 1, 10**9) for k in range(6)]
        rows.append((110 + i, f"{own[0]} Bo {own[1]} O'Neil-Smith {own[2]} A-4471/7 {own[3]} or {own[4]} at +1 (456) 555-2186 The {own[5]}"))
    rows.append((120, "bo and o'neil-smith: (a-4471/7) quokkaclub or the rest"))
    texts = dict(rows)
    found = set()
    for r in disclosure.report(docs(rows)).collect():
        spans = [s.split(":") for s in r.spans.split(",") if s]
        found |= {(r.doc_id, texts[r.doc_id][int(a) : int(b)].lower()) for k, a, b in spans if k in ("generalised", "removed")}
    names = {"bo", "o'neil-smith", "a-4471/7"}
    assert found == {(100, "quokkaclub"), (101, "quokkaclub"), (120, "quokkaclub")} | {(d, x) for d in (110, 111, 112, 113, 120) for x in names}


def test_columns_with_names_in_use_inside(docs):
    df = docs([(1, "to a.b@c.de now"), (None, None)]).withColumnsRenamed({"key": "_spans", "node": "_d", "part": "_t", "root": "_row"})
    out = disclosure.sanitise(df)
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == df.columns and got[1]["text"] == "to [EMAIL] now" and got[1]["_spans"] == "k" and got[None]["_row"] == "r"
