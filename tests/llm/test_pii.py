import re

from hypothesis import given, settings
from hypothesis import strategies as st

from graphtide.llm.pii import disguised, find_pii, mask_pii, masked, plain


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def naive(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


@given(st.text(alphabet="a.@_+19 -(b", max_size=60))
@settings(max_examples=400, deadline=None)
def test_plain_matches_the_patterns(text):
    assert plain(text) == naive(text)


@given(st.text(alphabet="14 -", min_size=14, max_size=40))
@settings(max_examples=200, deadline=None)
def test_cards(text):
    assert plain(text) == naive(text)


CASES = [
    ("mail ann.b [at] exa [dot] org now", "email", "ann.b [at] exa [dot] org"),
    ("ann (at) exa.org", "email", "ann (at) exa.org"),
    ("ann at exa dot co dot uk!", "email", "ann at exa dot co dot uk"),
    ("ａｎｎ＠exa。org", "email", "ａｎｎ＠exa。org"),
    ("аnn@exа.org", "email", "аnn@exа.org"),
    ("call plus four nine one five one two three four five six", "phone", "plus four nine one five one two three four five six"),
    ("plus vier neun eins zwei drei vier fünf sechs sieben acht.", "phone", "plus vier neun eins zwei drei vier fünf sechs sieben acht"),
    ("at one nine two dot one six eight dot one dot two", "ip", "one nine two dot one six eight dot one dot two"),
    ("host 192 dot 168 dot 1 dot 10 is up", "ip", "192 dot 168 dot 1 dot 10"),
    ("in 2020, 192 dot 168 dot one dot 10", "ip", "192 dot 168 dot one dot 10"),
    ("in 2020 one nine two dot 168 dot 1 dot 10", "ip", "one nine two dot 168 dot 1 dot 10"),
    ("in 2020 one nine two dot one six eight dot one dot two", "ip", "one nine two dot one six eight dot one dot two"),
    ("call +49 one five one 2345678 now", "phone", "+49 one five one 2345678"),
    ("call plus four nine 151 2345678", "phone", "plus four nine 151 2345678"),
    ("call plus 49 151 2345678", "phone", "plus 49 151 2345678"),
    ("card 4111 one one one one 1111 1111", "card", "4111 one one one one 1111 1111"),
    ("ask john dot smith at example dot com", "email", "john dot smith at example dot com"),
    ("ask j dot r dot smith at example.com", "email", "j dot r dot smith at example.com"),
    ("ask john dot smith@example.com", "email", "john dot smith@example.com"),
    ("or j.smith@mail.example dot com now", "email", "j.smith@mail.example dot com"),
    ("or ann@exa.or\u200bg now", "email", "ann@exa.or\u200bg"),
    ("ask " + "j" * 200 + " dot smith at example dot com", "email", "j" * 200 + " dot smith at example dot com"),
]


def test_disguises_map_back():
    for text, kind, span in CASES:
        base = plain(text)
        found = disguised(text, base)
        assert [(k, text[a:b]) for k, a, b in found] == [(kind, span)], text
        assert masked(text, base + found) == text.replace(span, f"[{kind.upper()}]")


def test_prose_is_left_alone():
    for text in ("look at this dot", "we met at noon. dot", "no one at two or three", "one two three four five six seven eight", "é à ñ ü", "meet at example.com today"):
        assert plain(text) == [] and disguised(text, []) == [], text


def test_numbers_of_prose_are_left_alone():
    for text in ("plus 10 000 000 euros", "from 10 to one 250 dot 5", "two 4 six 800", "in 2020, one two 3 and 45", "at the red dot smith saw one"):
        assert plain(text) == [] and disguised(text, []) == [], text


def test_a_longer_span_stands_beside_the_plain_one():
    for text, inner in (("ask john dot smith@example.com", "smith@example.com"), ("j.smith@mail.example dot com", "j.smith@mail.example"), ("ann@exa.or\u200bg", "ann@exa.or")):
        (base,) = plain(text)
        (longer,) = disguised(text, [base])
        assert text[base[1]:base[2]] == inner and longer[1] <= base[1] and base[2] <= longer[2]


def test_base_spans_stay_with_disguised_ones():
    text = "a@b.cd and ann [at] exa [dot] org and +49 151 2345678"
    base = plain(text)
    assert [k for k, *_ in base] == ["email", "phone"] and len(disguised(text, base)) == 1


def test_long_runs_are_linear():
    for unit in ("a", "1", "1 ", "+1", "a@", "1.", "one "):
        plain(unit * 50_000)
    disguised("one two " * 5_000, [])
    for unit in ("one 22 ", "12 dot ", "a dot "):
        disguised(unit * 20_000, [])


def test_rows(spark, documents):
    rows = [(1, None), (2, ""), (3, "x a@b.cd"), (3, "x a@b.cd"), (4, "y" * 100_000 + " +49 151 2345678")]
    got = {(r.doc_id, r.n_email, r.n_phone, r.spans) for r in find_pii(documents(rows), keep=["doc_id", "score"]).collect()}
    assert got == {(1, 0, 0, ""), (2, 0, 0, ""), (3, 1, 0, "email:2:8"), (4, 0, 1, "phone:100001:100016")}
    assert sorted((r.doc_id, r.text) for r in mask_pii(documents(rows)).where("doc_id < 4").collect() if r.text) == [(3, "x [EMAIL]")] * 2
    assert find_pii(documents([(1, "a")]).where("false")).count() == 0
