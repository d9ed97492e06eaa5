"""Secrets and personal data: base patterns, learned spans, masking."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SMALL
from tradewind.llm import pii, queries, secrets, spans

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)


def plain_secrets(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def plain_luhn(digits):
    doubled = [2 * int(d) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_personal(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(part) <= 255 for part in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and plain_luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


def random_texts(count):
    rng = random.Random(0)
    parts = ["a", "f", "0", "9", "1", "4", "@", ".", "-", "+", " ", "(", ")", "=", ":", '"', "'",
             "token", "API_KEY", "passwd ", "AKIA", "Z", "\n", "é", "_", "%", "4111111111111111",
             "1.2.3.4", "x@y.z", "ſecret", "apiKey", "\U0001f600", "256", "\x0b"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(count)]


def test_base_spans_equal_the_plain_patterns():
    for text in random_texts(8000):
        assert sorted(secrets.base_spans(text)) == plain_secrets(text)
        assert sorted(pii.base_spans(text)) == plain_personal(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 100_000, "1 " * 100_000,
                                  "a.b@" * 50_000, "+1 (" * 50_000, "token=" * 50_000,
                                  "a1b2c3d4 " * 20_000, "x1" * 100_000 + "@"])
def test_very_long_texts_take_linear_time(text):
    secrets.tokens(text)
    secrets.base_spans(text)
    pii.base_spans(text)
    pii.identifier_tokens(text)


def test_outside_and_replaced():
    taken = [(5, 0, 10), (20, 1, 22), (6, 0, 18)]
    assert spans.outside([(0, 3, 5), (0, 3, 6), (17, 3, 19), (18, 3, 20), (21, 3, 30)], taken) == [
        (0, 3, 5), (18, 3, 20)]
    assert spans.outside([(1, 3, 2)], []) == [(1, 3, 2)]
    assert spans.replaced("0123456789", [(2, 0, 4), (3, 1, 6), (8, 1, 9)], ("<a>", "<b>")) \
        == "01<a>67<b>9"
    assert spans.written_out([(3, 1, 4), (3, 0, 5)], ("a", "b")) == "a:3:5,b:3:4"


def expected_columns(text, plain, kinds):
    found = plain(text)
    line = ",".join(f"{kinds[kind]}:{start}:{end}" for start, kind, end in found)
    return ([sum(kind == k for _, kind, _ in found) for k in range(len(kinds))],
            hashlib.sha256(line.encode()).hexdigest(), set(filter(None, line.split(","))))


@pytest.mark.parametrize("name, plain, kinds", [
    ("op1_secrets", plain_secrets, ("assign", "access", "hex")),
    ("op3_pii", plain_personal, ("email", "ip", "card", "phone"))])
def test_span_queries(spark, name, plain, kinds):
    documents = {r.doc_id: r.text for r in
                 spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = queries.queries()[name](spark, SMALL).collect()
    assert len(found) == len(documents)
    for row in found:
        numbers, digest, base = expected_columns(documents[row.doc_id], plain, kinds)
        assert [row[f"n_{kind}"] for kind in kinds] == numbers
        assert row.base_sha256 == digest
        listed = row.spans.split(",") if row.spans else []
        assert base <= set(listed)
        starts = [int(span.split(":")[1]) for span in listed]
        assert starts == sorted(starts)
        assert all(int(span.split(":")[2]) <= len(documents[row.doc_id]) for span in listed)


# --- the field ---------------------------------------------------------------------------

def brute_decode(field, numbers):
    from itertools import product
    scores = field.scores(numbers)

    def value(tags):
        return sum(field.moves[a, b] + scores[t, b]
                   for t, (a, b) in enumerate(zip((0, *tags), tags, strict=False)))
    return max(product(range(3), repeat=len(numbers)), key=value)


def plain_own_names(token):
    shape = re.sub("[0-9]+", "9", re.sub("[A-Z]+", "A", re.sub("[a-z]+", "a", token)))
    size, counts = len(token), Counter(token)
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
    digits = sum(counts[d] for d in "0123456789")
    return ["bias", f"shape {shape[:8]}", f"changes {min(8, len(shape) // 3)}",
            f"size {min(10, size // 4)}", f"entropy {min(16, int(2 * entropy + 1e-9))}",
            f"digits {4 * digits // size}", f"lower {any(c.islower() for c in token)}",
            f"upper {any(c.isupper() for c in token)}", f"dots {min(3, token.count('.'))}",
            f"dashes {min(3, token.count('-'))}", f"first {token[0]}"]


def test_features_equal_plain_ones():
    rng = random.Random(4)
    letters = "abzAZ019+/=_.~-"
    found = ["".join(rng.choice(letters[:rng.randint(1, 15)]) for _ in range(rng.randint(1, 80)))
             for _ in range(500)] + ["x" * 100_000, "9", "ab" * 8, "abcdefgh", "--", "Aa9" * 30]
    expected = [[zlib.crc32(name.encode()) % secrets.FEATURES for name in plain_own_names(token)]
                for token in found]
    assert secrets.own_numbers(found).tolist() == expected
    assert secrets.own_numbers([]).shape == (0, secrets.OWN_FEATURES)
    text = "Its key is: tok_ABCDEF12 (see the é manual)"
    start = text.index("tok_")
    assert secrets.context_numbers(text, start, start + 12, (7,)) == [
        *(zlib.crc32(f"word {place} {word}".encode()) % secrets.FEATURES for place, word in (
            ("-1", ":"), ("-2", "is"), ("-3", "key"), ("+1", "("))), 7]


def test_viterbi_and_gradient_equal_brute_force():
    rng = np.random.default_rng(3)
    weights = rng.standard_normal((50, 3))
    moves = rng.standard_normal((3, 3))
    moves[0, 2] = secrets._FORBIDDEN
    field = secrets.Field(weights, moves)
    for length in (1, 2, 5):
        numbers = rng.integers(0, 50, (length, 4)).tolist()
        assert tuple(field.decode(field.scores(numbers), [len(numbers)])) == brute_decode(field, numbers)
        # chains side by side, also of one length
        lengths = [1, len(numbers), 1, len(numbers)]
        together = field.decode(field.scores(
            [numbers[0], *numbers, numbers[-1], *numbers]), lengths).tolist()
        alone = [list(brute_decode(field, part)) for part in (
            numbers[:1], numbers, numbers[-1:], numbers)]
        assert together == [tag for tags in alone for tag in tags]
        scores = field.scores(numbers)[None]
        expected, pairs = secrets._expectations(scores, moves)
        from itertools import product
        weight, tags_seen, moves_seen = 0.0, np.zeros((length, 3)), np.zeros((3, 3))
        for tags in product(range(3), repeat=length):
            p = np.exp(sum(moves[a, b] + scores[0, t, b] for t, (a, b) in enumerate(
                zip((0, *tags), tags, strict=False))))
            weight += p
            for t, (a, b) in enumerate(zip((0, *tags), tags, strict=False)):
                tags_seen[t, b] += p
                moves_seen[a, b] += p
        assert np.allclose(expected[0], tags_seen / weight)
        assert np.allclose(pairs, moves_seen / weight)


def made_up_documents(count, rng):
    """Prose with secrets that the patterns know, some that they don't, and harmless numbers."""
    words = "the old house by river was sold again last year for little money".split()
    rows, hidden = [], []
    for i in range(count):
        text = " ".join(rng.choice(words) for _ in range(30))
        if i % 4 == 0:
            value = "".join(rng.choice("abcdefghijkmnpqrstuvwxyz23456789XYZ") for _ in range(24))
            value = "k3" + value
            name = "token" if i % 20 else "credential"
            text += f' {name} = "{value}" ' + rng.choice(words)
            if name == "credential":
                hidden.append((i, value))
        elif i % 4 == 1:
            text += f" on 2021-{rng.randint(10, 12)}-{rng.randint(10, 28)} at 12:30:15 call 555-1234"
        rows.append((i, text))
    return rows, hidden


def test_field_finds_secrets_without_a_pattern(spark):
    rows, hidden = made_up_documents(400, random.Random(1))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in secrets.find_secrets(frame).collect()}
    hits = sum(any(rows[i][1][s.start:s.end] == value for s in found[i].added)
               for i, value in hidden)
    assert hits >= 0.9 * len(hidden)
    wrong = [r.doc_id for r in found.values() if r.doc_id % 4 and r.added]
    assert not wrong
    assert all(not found[i].added for i in range(4, 400, 4) if i % 20)  # the base has those


def test_tokens_and_chains():
    text = 'key = "abcdefghijk" \n\n        -----    ABCD1234.. or éabcdefgh short x' + "y" * 400 + "\u00e9"
    found = secrets.tokens(text)
    assert [text[s:e] for s, e in found] == ["abcdefghijk", "ABCD1234", "abcdefgh", "x" + "y" * 400]
    assert [len(run) for run in secrets.chains(text, found)] == [2, 1, 1]
    late = "a" * 300 + "1B" * 300  # its features are those of the whole
    assert {"digits 1", "upper True"} <= set(plain_own_names(late))


def test_field_finds_secrets_of_letters(spark):
    rng = random.Random(7)
    words = ("the old house by river was sold yesterday without difficulty although password "
             "protection remained important everywhere").split()
    rows, hidden = [], {}
    for i in range(600):
        text = " ".join(rng.choice(words) for _ in range(30))
        if i % 3 == 0:
            value = "".join(rng.choice("qwrtzpsdfghjklxcvbnmQWRTZPSDFGHJKLXCVBNM") for _ in range(20))
            name = "credential" if i % 15 == 0 else "password"
            text += f' {name} = "{value}" ' + rng.choice(words)
            if i % 15 == 0:
                hidden[i] = value
        rows.append((i, text))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: [rows[r.doc_id][1][s.start:s.end] for s in r.added]
             for r in secrets.find_secrets(frame).collect()}
    assert sum(found[i] == [value] for i, value in hidden.items()) >= 0.9 * len(hidden)
    assert not any(spans for i, spans in found.items() if i not in hidden)


def test_secrets_of_odd_rows(spark):
    long = "x " * 50_000 + "token = abcdefabcdef1234"
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "AKIA" + "A" * 14), (4, " \n")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "1 AS base", "2 AS row_id")
    found = secrets.find_secrets(frame).collect()
    assert [(r.doc_id, [(s.kind, s.end - s.start) for s in r.base]) for r in found] == [
        (1, []), (2, []), (3, [("assign", 24), ("hex", 16)]), (3, [("assign", 24), ("hex", 16)]),
        (None, [("access", 18)]), (4, [])]
    assert secrets.find_secrets(frame.limit(0)).count() == 0
    assert secrets.train([]) is None and secrets.train([([[1]], [0])]) is None


# --- bootstrapping -----------------------------------------------------------------------

def test_contexts_find_identifiers(spark):
    rows = []
    for i in range(12):
        rows.append((i, f"please write to customer mailbox person{i}@mail.example.com today"))
        rows.append((100 + i, f"the year {1990 + i} brought {10000 + i} visitors to town"))
    rows.append((50, "please write to customer mailbox K-8812345 today"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in pii.find_personal_data(frame).collect()}
    text = dict(rows)[50]
    assert [text[s.start:s.end] for s in found[50].added] == ["K-8812345"]
    assert all(not r.added for r in found.values() if r.doc_id != 50)
    masked = {r.doc_id: r.text for r in pii.mask(frame).collect()}
    assert masked[50] == "please write to customer mailbox [FOUND] today"
    assert masked[0] == "please write to customer mailbox [EMAIL] today"
    assert masked[100] == dict(rows)[100]


@pytest.mark.parametrize("text, tokens", [
    ('{"name":"x","customer_id":"88123456","n":' + "1," * 90 + '"mail":"me@here"}',
     ["88123456", "1," * 89 + "1", "me@here"]),
    ("a" * 100 + "=1&account=8812345&next=" + "b" * 100, ["8812345"]),
    ("sku,K-8812345,7,x@y," + "word," * 40, ["K-8812345", "x@y"]),
    ("客户编号88123456的订单已于昨天发货" * 9, ["88123456"] * 9),
    ("номер88123456,см.выше", ["88123456"]),
    ("K" + "1" * 80, ["K" + "1" * 80]),
    (":".join(["A1"] * 32), [":".join(["A1"] * 32)]),
    ("(id:8812345)", ["id:8812345", "8812345"]),
    ("1,234,567 MÜLLER12345 А123ВС77 2021年10月12日", ["1,234,567", "MÜLLER12345", "А123ВС77",
                                                    "2021年10月12日"])])
def test_identifiers_in_runs_without_blanks(text, tokens):
    assert [text[s:e] for s, e in pii.identifier_tokens(text)] == tokens


def test_contexts_find_identifiers_in_runs_without_blanks(spark):
    rows = []
    for i in range(12):
        rows.append((i, '{"a":"' + "x" * 70 + f'","mailbox":"person{i}@mail.example.com"}}'))
        rows.append((20 + i, f"客户邮箱person{i}@mail.example.org的订单" + "已发货" * 30))
        rows.append((40 + i, f"please write to mister person{i}@mail.example.net today"))
    rows += [(100, '{"a":"' + "x" * 70 + '","mailbox":"K-8812345"}'),
             (101, "客户邮箱8812346的订单" + "已发货" * 30),
             (102, "please write to mister " + "K8" * 60 + " today")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.added for r in pii.find_personal_data(frame).collect()}
    assert {i: [dict(rows)[i][s.start:s.end] for s in added]
            for i, added in found.items() if added} == {
        100: ["K-8812345"], 101: ["8812346"], 102: ["K8" * 60]}


def test_nested_spans_outside():
    assert spans.outside([(0, 4, 15), (3, 4, 8)], [(9, 0, 15)]) == [(3, 4, 8)]


def plain_scores(edges):
    scores = {}
    for _, instance, known in edges:
        scores[instance] = max(scores.get(instance, 0.0), float(known))
    seeds = {i for i, s in scores.items() if s}
    pairs = {(p, i) for p, i, _ in edges}
    rise = 1.0
    while rise > pii.MIN_RISE:
        accepted, before = {}, dict(scores)
        for pattern in {p for p, _ in pairs}:
            own = [scores[i] for p, i in pairs if p == pattern]
            if sum(s >= 0.9 for s in own) >= 3 and sum(own) / len(own) >= 0.8:
                accepted[pattern] = sum(own) / len(own)
        for instance in scores:
            doubt = 1.0
            for p, i in pairs:
                if i == instance and p in accepted:
                    doubt *= max(1 - accepted[p], 1e-6)
            scores[instance] = 1.0 if instance in seeds else 1 - doubt
        rise = max(scores[i] - before[i] for i in scores)
    return accepted, scores


def test_graph_scores_equal_a_plain_loop(spark):
    rng = random.Random(4)
    edges = [(f"p{rng.randint(0, 6)}", f"i{n}", n < 30) for n in
             (rng.randint(0, 38) for _ in range(150))]
    frame = spark.createDataFrame(edges, "pattern string, instance string, known boolean")
    patterns, scores = pii.score_graph(frame)
    accepted, expected = plain_scores(edges)
    assert {r.pattern: round(r.confidence, 9) for r in patterns.collect()} == {
        p: round(c, 9) for p, c in accepted.items()}
    assert {r.instance: round(r.score, 9) for r in scores.collect()} == {
        i: round(s, 9) for i, s in expected.items()}


def test_chains_of_patterns_are_followed_to_the_end(spark):
    # each pattern holds 20 instances of the one before and one more
    edges = [(f"p{k}", f"i{n}", n < 20) for k in range(12) for n in range(k, k + 21)]
    frame = spark.createDataFrame(edges, "pattern string, instance string, known boolean")
    patterns, scores = pii.score_graph(frame)
    accepted, expected = plain_scores(edges)
    assert {r.pattern for r in patterns.collect()} == set(accepted) == {f"p{k}" for k in range(12)}
    assert {r.instance for r in scores.collect() if r.score >= pii.MIN_SCORE} == {
        i for i, s in expected.items() if s >= pii.MIN_SCORE}


def test_identifiers_at_the_start_are_found_by_what_follows(spark):
    rows = [(i, f"person{i}@mail.example.com is the mailbox of customer {i}") for i in range(20)]
    rows += [(100 + i, f"{8812345 + i} is the mailbox of customer {i}") for i in range(4)]
    rows += [(200, "1234567 was the count of visitors")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: [(s.start, s.end) for s in r.added]
             for r in pii.find_personal_data(frame).collect()}
    assert {i for i, added in found.items() if added} == {100, 101, 102, 103}
    assert all(found[i] == [(0, 7)] for i in range(100, 104))


def test_words_of_a_context_are_whole():
    word = "w" * 200
    text = f"{word} {word} a@b {word} x"
    start = text.index("a@b")
    whole = pii._instance(word)
    assert pii._Contexts(text).patterns(start, start + 3) == [
        f"{whole} _", f"{whole} {whole} _", f"{whole} _ {whole}", f"_ {whole}", f"_ {whole} x"]
    joined = "номер88123456см"
    assert pii._Contexts(joined).patterns(5, 13) == ["номер _", "номер _ см", "_ см"]


def test_personal_data_of_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "a@b.cd", 5), (3, "a@b.cd", 5), (None, "1.2.3.4", 5),
            (4, "+49 30 1234567 " * 2000, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint").selectExpr(
        "*", "1 AS found", "2 AS text_key", "3 AS base")
    found = pii.find_personal_data(frame).collect()
    assert sorted((str(r.doc_id), len(r.base)) for r in found) == [
        ("1", 0), ("2", 0), ("3", 1), ("3", 1), ("4", 2000), ("None", 1)]
    masked = pii.mask(frame)
    assert masked.columns == frame.columns
    texts = sorted((str(r.doc_id), r.text, r.n_chars) for r in masked.where(
        "doc_id IS NULL OR doc_id IN (2, 3)").collect())
    assert texts == [("2", "", 0), ("3", "[EMAIL]", 7), ("3", "[EMAIL]", 7), ("None", "[IP]", 4)]
    assert masked.where("doc_id = 1").first().n_chars == 5
    assert pii.find_personal_data(frame.limit(0)).count() == 0
    assert pii.mask(frame.limit(0)).count() == 0
