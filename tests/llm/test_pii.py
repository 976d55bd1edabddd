"""Spans against the plain patterns, and disclosure against counts over all documents."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest

from reportmart.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        total = 0
        for at, d in enumerate(reversed(digits)):
            d = int(d) * (1 + at % 2)
            total += d - 9 if d > 9 else d
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return True


def base(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text)
        if valid(kind, m.group())
    ]


def written(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def check(df, rows):
    found = {r.doc_id: r for r in pii.personal_spans(df).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        spans = base(text or "")
        assert found[i].base == written(spans), text
        assert [found[i][f"n_{k}"] for k in PLAIN] == [
            sum(s[0] == k for s in spans) for k in PLAIN
        ]
    return found


CARD = "4111 1111 1111 1111"
TEXTS = [
    None,
    "",
    f"é漢😀 a@b.c_d@e.f, x..y@@z.q, {CARD} and {CARD[:-1]}2",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3 007.0.0.255 1.2.3.4 99999999999.1.1.1",
    "+1 (555) 010-9999 +12345678 ++1 2 3+4444444 +1 " + "1 " * 9,
    f"{CARD}@mail.example.com +{CARD} {CARD}0 4111-1111 1111-1111-4111",
    "a@b.c" * 50 + " 1.1.1.1" * 50,
    "1" * 2000 + " " + "a" * 2000 + "@" + "1." * 2000 + "1",
    "+" * 2000 + "1" + "(" * 2000,
    "%%@a.b- -@-.-\n+0--------0 +00000000",
]


def test_spans(clashing):
    check(clashing(TEXTS), list(enumerate(TEXTS)))
    assert pii.personal_spans(clashing([])).collect() == []


def test_very_long_texts(documents):
    """What the plain patterns would take too long for."""
    long = "1" * 200_000 + " " + "a" * 300_000 + "@" + "1." * 100_000 + "1 " + "+" * 100_000
    found = pii.personal_spans(documents([long, "x " * 500_000])).collect()
    counts = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in found}
    assert counts == {0: (1, 25_000, 0, 0), 1: (0, 0, 0, 0)}
    email = next(r for r in found if r.doc_id == 0).spans.split(",")[0]
    assert email == f"email:200001:{200_001 + 300_001 + 200_001}"


def test_random_texts(documents):
    rng = random.Random(1)
    parts = ["a", "B", "@", ".", "1", "23", "255", "+", "-", " ", "(", ")", "%", "é", "_", "\n", CARD]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(3000)]
    check(documents(texts), list(enumerate(texts)))


def test_rows_that_repeat_an_id(clashing):
    rows = [(1, "x a@b.cd"), (1, "x a@b.cd"), (1, "none"), (None, "a@b.cd")]
    found = pii.personal_spans(clashing(rows)).collect()
    assert sorted((r.n_email, r.spans) for r in found) == [
        (0, ""),
        (1, "email:0:6"),
        (1, "email:2:8"),
        (1, "email:2:8"),
    ]


def letters(text):
    return re.findall(r"[^\W\d_]+", text.lower())


def brute_terms(texts, chance=0.05, generalise=0.75, remove=0.95):
    """Terms to generalise and to remove, by document, as the operator defines them."""
    texts = [t or "" for t in texts]
    n, entities, words, df_t = len(texts), [], [], {}
    for text in texts:
        found = set()
        for kind, pattern in PLAIN.items():
            for m in re.finditer(pattern, text):
                if valid(kind, m.group()):
                    plain = m.group().lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", m.group())
                    found.add((kind, plain))
        entities.append(found)
        words.append(["", "", *letters(re.sub(PLAIN["email"], " ", text)), "", ""])
        for term in set(letters(text)):
            df_t[term] = df_t.get(term, 0) + 1
    df_e = Counter(e for found in entities for e in found)
    co, contexts = {}, {}
    for i, (found, said) in enumerate(zip(entities, words)):
        for entity in found:
            if df_e[entity] > 1:
                for at in range(2, len(said) - 2):
                    pair = entity, said[at]
                    co.setdefault(pair, set()).add(i)
                    around = (*said[at - 2 : at], *said[at + 1 : at + 3])
                    contexts.setdefault(pair, set()).add(around)
    ratios = {}
    for (entity, term), docs in co.items():
        x = min(len(docs), len(contexts[entity, term]))
        expected = df_t[term] * df_e[entity] / n
        if x > expected and len(co) * (math.e * expected / x) ** x <= chance and df_e[entity] < n:
            mutual = math.log(len(docs) * n / (df_t[term] * df_e[entity]))
            ratio = mutual / math.log(n / df_e[entity])
            for i in docs:
                ratios[i, term] = max(ratio, ratios.get((i, term), 0))
    return [
        (
            sorted(t for (d, t), r in ratios.items() if d == i and generalise <= r < remove),
            sorted(t for (d, t), r in ratios.items() if d == i and r >= remove),
        )
        for i in range(n)
    ]


def disclosing():
    rng = random.Random(2)
    common = ["water", "stone", "light", "river", "cloud", "wind", "grass", "hill", "sand"]
    texts = []
    for i in range(300):
        words = rng.choices(common, k=12)
        if i % 10 == 0:  # one address, always beside one name
            words[6:6] = ["Rumpelstil", rng.choice(common), f"near boss@{'castle'}.example"]
        elif i % 10 == 1:
            words[3:3] = ["often", "10.0.0.7", "gate"]
        elif i % 20 == 2:
            words[3:3] = ["often"]
        texts.append(" ".join(words))
    return texts


def test_disclosure(documents):
    texts = disclosing()
    found = check(documents(texts), list(enumerate(texts)))
    terms = brute_terms(texts)
    assert any("rumpelstil" in t[1] for t in terms)
    assert any("often" in t[0] for t in terms)
    for i, text in enumerate(texts):
        spans = base(text)
        for kind, some in zip(("generalised", "removed"), terms[i]):
            if some:
                pattern = rf"(?i)(?<![^\W])(?:{'|'.join(some)})(?!\w)"
                spans += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text)]
        assert found[i].spans == written(spans)


def test_copies_of_a_page_are_no_evidence(documents):
    """Words that only stand in copies of one phrase beside an address stay."""
    rng = random.Random(4)
    page = "Rumpel writes to rumpel@home.example about +1 555 010 9999 today"
    texts = [" ".join(rng.choices(["water", "stone", "light", "river"], k=9)) for _ in range(90)]
    texts = [page] * 5 + [f"{page} {t}" for t in texts[:5]] + texts[5:]
    cleaned = {r.doc_id: r.text for r in pii.sanitise(documents(texts)).collect()}
    assert all(cleaned[i].startswith("Rumpel writes to [EMAIL] about [PHONE] today") for i in range(10))


def test_sanitise(clashing):
    texts = [*disclosing(), None, f"card {CARD}, a@b.cd +1 (555) 010-9999 1.2.3.4 1.2.3.444", "plain"]
    docs = clashing(texts)
    cleaned = pii.sanitise(docs)
    assert cleaned.columns == docs.columns
    by_id = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert len(by_id) == len(texts)
    assert by_id[300] is None and by_id[302] == "plain"
    assert by_id[301] == "card [CARD], [EMAIL] [PHONE] [IP] 1.2.3.444"
    assert all("Rumpelstil" not in t and "castle" not in t for t in by_id.values() if t)
    assert "[TERM] [IP]" in by_id[1]
    assert by_id[3] == texts[3]
    assert pii.sanitise(clashing([])).collect() == []


def expected_cut(text):
    """The text without its base spans; spans that overlap are one, named by start and kind."""
    runs = []
    for kind, start, end in sorted(base(text), key=lambda s: (s[1], s[2])):
        if not runs or start >= runs[-1][1]:
            runs.append([start, end, []])
        runs[-1][1] = max(end, runs[-1][1])
        runs[-1][2].append((start, list(PLAIN).index(kind), kind))
    for start, end, kinds in reversed(runs):
        names = dict.fromkeys(k for *_, k in sorted(kinds))
        text = text[:start] + "".join(f"[{k.upper()}]" for k in names) + text[end:]
    return text


def test_overlapping_spans_go_whole(documents):
    given = f"pay {CARD}@mail.example.com now"
    assert base(given) and expected_cut(given) == "pay [CARD][EMAIL] now"
    rng = random.Random(9)
    parts = ["a", "@", ".", "1", "23", "255", "+", "-", " ", "x y", "é😀", CARD, "a@b.cd", "1.2.3.4", "+1 555 010 99"]
    texts = [given, "", None] + ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(500)]
    texts.append("word 1.1.1.1 " * 3000 + CARD)
    for r in pii.sanitise(documents(texts)).collect():
        cut = expected_cut(texts[r.doc_id]) if texts[r.doc_id] else texts[r.doc_id]
        # What is left may hold a match that a dropped one hid before.
        assert r.text == cut or base(cut) and not base(r.text)


def test_digest_of_spans(documents):
    text = f"a@b.cd {CARD}"
    row = pii.personal_spans(documents([text])).first()
    assert hashlib.sha256(row.base.encode()).hexdigest() == hashlib.sha256(
        b"email:0:6,card:7:26"
    ).hexdigest()


def test_terms_far_away_and_short(documents):
    """A short name at the top discloses an address that comes much later."""
    rng = random.Random(7)
    fill = lambda: " ".join(rng.choices(["water", "stone", "light", "river", "cloud", "wind"], k=100))
    texts = [f"Zoe {fill()} me@home.example" if i % 10 == 0 else f"Who {fill()}" for i in range(100)]
    found = {r.doc_id: r.spans for r in pii.personal_spans(documents(texts)).collect()}
    assert found[0] == f"email:{len(texts[0]) - 15}:{len(texts[0])},removed:0:3"
    assert found[1] == ""
    cleaned = {r.doc_id: r.text for r in pii.sanitise(documents(texts)).collect()}
    assert cleaned[0] == texts[0][3:-15] + "[EMAIL]" and cleaned[1] == texts[1]


def test_terms_inside_base_spans_are_no_spans(documents):
    rng = random.Random(3)
    fill = lambda: " ".join(rng.choices(["water", "stone", "light", "river", "cloud", "wind"], k=9))
    texts = [f"{fill()} Zoe {fill()} zoe@home.example" if i % 10 == 0 else fill() for i in range(100)]
    for r in pii.personal_spans(documents(texts)).collect():
        kinds = [s.split(":")[0] for s in r.spans.split(",")]
        assert kinds == (["email", "removed"] if r.doc_id % 10 == 0 else [""])
