import math
import re
from collections import Counter


from graphtide.llm.divergence import COMMON_WORDS, apply_rules, judge, measure, references

GOOD = "the cat and the dog are on the mat with the others, and it was not for them to be in that house by night. " * 2
ROWS = [(1, None), (2, ""), (3, " \n\t"), (4, "a b a b a b c"), (5, "x\nx\n\nx \ny\n"), (6, GOOD + "of it"), (7, "#* $a &|<> a#"), (8, "w1 w2 w3 w4 w1 w2 w3 " + " ".join(f"z{k}" for k in range(60)))]


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def js(p, q):
    half = lambda a, b: a * math.log2(2 * a / (a + b)) if a else 0.0
    return math.sqrt(max(0, sum(half(a, b) + half(b, a) for a, b in zip(p, q)) / 2))


def test_base_measures(documents):
    long = [(20, " ".join(f"w{k % 997}" for k in range(30_000))), (21, "ab " * 20_000)]
    for r in measure(documents(ROWS + long), keep=["doc_id"]).collect():
        text = dict(ROWS + long)[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), r.doc_id
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert sum(r.chars) == len(text or "")


def test_distances_against_definition(documents):
    words = sorted({w for g in COMMON_WORDS.values() for w in g})
    texts = {k: " ".join(f"{w} n{k}x{i}" for i, w in enumerate(COMMON_WORDS[lang] * 2)) + f" QX{k}. 12" for k, lang in enumerate(["en", "en", "de"])}
    docs = documents([(k, t, ["en", "en", "de"][k]) for k, t in texts.items()])
    measured = measure(docs, keep=["doc_id", "lang"])
    known = references(measured, "lang")
    assert set(known) == {"en", "de"}

    def shares(text):
        c = Counter(w for w in text.split() if w in set(words))
        n = len(text.split())
        return [c[w] / n for w in words] + [1 - sum(c.values()) / n]

    rows = {r.doc_id: r for r in judge(measured, known).collect()}
    for k, text in texts.items():
        best = min(js(shares(text), [w.get(i, 0.0) for i in range(len(words))] + [w[-1]]) for _, w in known.values())
        assert abs(rows[k].word_distance - best) < 1e-6
        chars = [c / len(text) for c in rows[k].chars]
        assert any(abs(rows[k].char_distance - js(chars, c)) < 1e-6 for c, _ in known.values())


def test_rows(documents):
    clean = [(100 + k, " ".join(COMMON_WORDS["en"][(k * 7 + i * i) % 29] if i % 2 else f"w{i}x{k}" for i in range(90))) for k in range(5)]
    junk = [(200, " ".join(f"{'ABCDEFGHIJ'[i % 10] * 3}{'QRSTUVW'[i % 7]}{i * i}" for i in range(90)))]
    got = {r.doc_id: r for r in apply_rules(documents(ROWS + clean + junk), keep=["doc_id", "score"]).collect()}
    assert all(got[k].kept for k, _ in clean) and not got[200].kept and not got[200].base_failed
    assert not any(got[k].kept for k in (1, 2, 3, 4))
    unknown = apply_rules(documents([(k, t, "xx") for k, t in clean]), keep=["doc_id"])
    assert unknown.where("kept").count() == len(clean)
    assert apply_rules(documents(ROWS).where("false"), keep=["doc_id"]).count() == 0


def test_a_language_without_words_is_not_held_to_the_word_limit(documents):
    clean = [(100 + k, " ".join(COMMON_WORDS["en"][(k * 7 + i * i) % 29] if i % 2 else f"w{i}x{k}" for i in range(90))) for k in range(5)]
    fifth = " ".join("kalo" if i % 2 else f"w{i}x3" for i in range(90))
    docs = documents([*clean, (1, fifth, "fi"), (2, fifth, "en"), (3, "XQ" * 300 + " 9" * 120, "fi")])
    kept = {r.doc_id: r.kept for r in apply_rules(docs, keep=["doc_id"]).collect()}
    assert kept[1] and not kept[2] and not kept[3]


def test_clashing_columns(documents):
    docs = documents([(1, GOOD)]).withColumnsRenamed({"score": "N_WORDS", "label": "Chars", "node": "common", "rule": "KEPT"})
    done = apply_rules(docs, keep=["doc_id", "N_WORDS", "Chars", "common", "KEPT", "text"])
    assert done.columns[:4] == ["doc_id", "Chars", "common", "text"] and len({c.lower() for c in done.columns}) == len(done.columns)
    assert done.head().Chars == "x" and done.head().n_words == len(GOOD.split())
