import hashlib
import random

from tidemark.llm import merkle


def made(seed, n):
    rnd = random.Random(seed)
    words = [f"w{i}é" for i in range(500)]
    rows = [(i * 7, "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\n", "  "]) for _ in range(rnd.randint(0, 300)))) for i in range(n)]
    rnd.shuffle(rows)
    return rows


def check(got, rows):
    """Every row against the definition, the next document taken from the sorted rows."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1] or ""))
    want = []
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = (text[: len(text) - half] + following[:half]).encode()
        a, b, c = merkle.trees([text.encode(), edited, following.encode()])
        want.append((doc, len(text), hashlib.sha256(edited).hexdigest(), a, b, merkle.likeness(a, b), merkle.likeness(a, c)))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_next_documents_and_edits(documents):
    for rows in (made(1, 120), made(2, 1), made(3, 2)):
        check([tuple(r) for r in merkle.fingerprint_documents(documents(rows, 4)).collect()], rows)


def test_defined_cases(documents):
    rows = [*made(4, 40), (None, "no id"), (None, None), (14, "again"), (14, "again"), (15, ""), (16, None), (17, "word " * 30_000), (18, "😀é")]
    frame = documents(rows).withColumnRenamed("source", "bucket")
    got = [tuple(r) for r in merkle.fingerprint_documents(frame).collect()]
    check(got, rows)
    assert merkle.fingerprint_documents(documents([])).count() == 0


def test_equal_texts_and_edits_are_told_apart():
    rnd = random.Random(6)
    words = [rnd.choice("alpha beta gamma delta epsilon zeta".split()) + str(rnd.randint(0, 99)) for _ in range(2000)]
    text = " ".join(words)
    edited = " ".join([*words[:1000], "changed", *words[1001:]])
    spaced = text.replace(" ", "  ", 1)
    a, b, c, d, empty, none = merkle.trees([t.encode() for t in (text, text, edited, spaced, "", "")])
    assert a == b and a[:32] != c[:32] and a != d
    assert merkle.likeness(a, b) == 1 == merkle.likeness(empty, none) and merkle.likeness(a, empty) == 0
    assert 0.95 < merkle.likeness(a, c) < 1 and merkle.likeness(a, c) == merkle.likeness(c, a)
    assert 1 <= len(merkle.differing(a, c)) <= 2 and merkle.differing(a, b) == []
    half = merkle.trees([(text[: len(text) // 2] + " ".join(reversed(words[1000:]))).encode()])[0]
    assert 0.35 < merkle.likeness(a, half) < 0.65


def test_trees_do_not_depend_on_neighbours():
    texts = [t.encode() for _, t in made(8, 30)]
    assert merkle.trees(texts) == [merkle.trees([t])[0] for t in texts]


def test_lines_without_spaces_have_several_paragraphs():
    rnd = random.Random(9)
    for script in (range(0x4E00, 0x5A00), range(0x61, 0x7B), range(0xE01, 0xE2F)):
        text = "".join(chr(rnd.choice(script)) for _ in range(4000))
        edited, half = f"{text[:2000]}{chr(script[0])}{text[2001:]}", text[:2000] + text[:1999:-1]
        a, b, c, moved = merkle.trees([t.encode() for t in (text, edited, half, "x y " + text)])
        assert 0.9 < merkle.likeness(a, b) < 1 and 1 <= len(merkle.differing(a, b)) <= 2
        assert 0.3 < merkle.likeness(a, c) < 0.7 and merkle.likeness(a, moved) > 0.9
    # A run of one letter is cut by force only: one leaf, and at most one section with its point, per ``MOST`` bytes.
    assert all(len(x) <= 33 + 17 * -(-5000 // merkle.MOST) for x in merkle.trees([bytes([c]) * 5000 for c in range(0x61, 0x7B)]))
    texts = ["字" * 50 + text, "short", text, ""]
    assert merkle.trees([t.encode() for t in texts]) == [merkle.trees([t.encode()])[0] for t in texts]


def leaves(text):
    """Paragraphs of a text by the rule, place by place."""
    data = text.encode()
    words, at = [], 0
    for word in data.split():
        at = data.index(word, at)
        words.append((at, at + len(word)))
        at += len(word)
    grams = merkle.Words(merkle.np.array([0, len(data)]), merkle.np.frombuffer(data, merkle.np.uint8))
    allowed = {int(x) for x in merkle._word_cuts(grams, len(data))} | {int(x) for x in merkle._inner_cuts(grams)}
    assert allowed <= {a for a, _ in words} | {i for a, b in words if b - a > merkle.LONG for i in range(a, b)}
    allowed |= {i + 1 for i, c in enumerate(data) if c == 10}
    cuts, before = [0], 0
    for place in sorted(allowed - {0, len(data)}):
        if place - before >= merkle.LEAST:
            cuts.append(place)
        before = place
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True):
        start = a
        for k in range(1, -(-(b - a) // merkle.MOST)):
            end = a + merkle.MOST * k
            while data[end] & 0xC0 == 0x80:
                end -= 1
            out.append(data[start:end])
            start = end
        out.append(data[start:b])
    return out


def test_leaves_and_likeness_equal_a_plain_form():
    """Fingerprints and likenesses from lists of paragraphs, without trees."""
    texts = [t for _, t in made(11, 25) if t] + ["la " * 900, "字" * 700, "a\n" * 400, "x", "\n\n", "one line\nof two " * 90]
    digest = lambda x: hashlib.blake2b(x, digest_size=8).digest()[:4].hex()
    plain = [[digest(x) for x in leaves(t)] for t in texts]
    made_trees = merkle.trees([t.encode() for t in texts])
    assert [[p for s in merkle._sections(tree) for p in merkle._paragraphs(s)] for tree in made_trees] == plain
    for a, x in zip(made_trees, plain, strict=True):
        for b, y in zip(made_trees, plain, strict=True):
            common = sum(min(x.count(v), y.count(v)) for v in set(x))
            assert merkle.likeness(a, b) == (1.0 if x == y else 2 * common / (len(x) + len(y)))


def test_half_a_text_is_always_seen():
    """Texts of over 1,000 characters of which half is kept, repeats and small vocabularies included."""
    rnd = random.Random(12)
    small = [f"v{i}" for i in range(300)]
    kinds = [
        lambda n: "same " * (n // 5 + 1),
        lambda n: "one two three " * (n // 14 + 1),
        lambda n: "z" * n,
        lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n)),
        lambda n: " ".join(rnd.choice(small) for _ in range(n)),
        lambda n: " ".join("".join(rnd.choice("aeioustrnl") for _ in range(rnd.randint(1, 12))) for _ in range(n)),
        lambda n: "\n".join("".join(rnd.choice("aeiou ") for _ in range(rnd.randint(0, 40))) for _ in range(n)),
    ]
    for first in kinds:
        for second in kinds:
            for n in (510, 2000, 9000):
                kept = first(n)[:n]
                a, b = merkle.trees([(kept + second(n)[:n]).encode(), (kept + second(n + 77)[77 : n + 77][::-1]).encode()])
                assert merkle.likeness(a, b) >= 0.2, (kept[:40], n)


def test_one_change_in_a_long_text_of_few_words():
    rnd = random.Random(13)
    words = [f"u{i}" for i in range(300)]
    text = " ".join(rnd.choice(words) for _ in range(20_000))
    place = len(text) // 3
    for whole in (text, "again and " * 12_000):
        a, b = merkle.trees([whole.encode(), (whole[:place] + "X" + whole[place + 1 :]).encode()])
        assert merkle.likeness(a, b) > 0.99 and 1 <= len(merkle.differing(a, b)) <= 4
