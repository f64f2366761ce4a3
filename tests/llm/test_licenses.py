"""Operator 3 against a brute-force comparison of every line with every template."""

import random
import re
import textwrap

from meeple.llm import licenses

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def brute(text):
    text = ascii_lower(text or "")
    words = re.findall(PATTERN, text)
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    matches = set()
    for line in text.split("\n"):
        own = set(re.findall(PATTERN, line))
        for label, template in licenses.TEMPLATES:
            t = set(re.findall(PATTERN, ascii_lower(template)))
            if len(own & t) >= licenses.THRESHOLD * len(t) - 1e-9:
                matches.add((label, len(own & t) / len(t)))
    return len(words), places, matches


def corpus():
    rng = random.Random(8)
    pieces = [t for _, t in licenses.TEMPLATES] + ["the tree is of wood", "All rights", "Reserved. all RIGHTS reserved", "cc", "by CC-BY", "Éa ß Ü"]
    rows = []
    for i in range(150):
        lines = []
        for _ in range(rng.randint(0, 4)):
            words = rng.choice(pieces).split()
            if rng.random() < 0.5 and words:
                words.pop(rng.randrange(len(words)))
            if rng.random() < 0.4:
                words.insert(rng.randint(0, len(words)), "extra")
            rng.random() < 0.2 and rng.shuffle(words)
            lines.append(" ".join(words))
        rows.append((i, rng.choice(["\n", " "]).join(lines)))
    return rows + [(900, None), (901, ""), (902, "\n\n"), (903, "word " * 50_000 + "all rights reserved")]


def test_query_equals_brute_force(docs):
    rows = corpus()
    got = {r["doc_id"]: r for r in licenses.op3_license_scan(docs(rows)).collect()}
    assert len(got) == len(rows)
    some = 0
    for doc_id, text in rows:
        n, places, matches = brute(text)
        r = got[doc_id]
        assert r["n_words"] == n and r["n_base"] == len(places)
        assert r["first_word"] == (min(p for p, _ in places) if places else None)
        assert r["last_word"] == (max(p for p, _ in places) if places else None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert r["labels"] == ",".join(sorted({x for _, x in places} | {x for x, _ in matches}))
        assert abs(r["score"] - (1.0 if places else max([s for _, s in matches], default=0.0))) < 1e-12
        some += bool(matches)
    assert some > 30


def test_empty_table_and_templates(docs):
    assert licenses.op3_license_scan(docs([])).count() == 0
    assert licenses.scan(docs([(1, "a b")]), []).first()["matches"] == []


def test_wrapped_notices_match(docs):
    """Every template wrapped at 40 columns, as in a source file's comment, is found as on one line."""
    rows, labels = [], {}
    for i, (label, text) in enumerate(licenses.TEMPLATES):
        lines = textwrap.wrap(text, 40)
        rows.append((i, "import os\n\n# " + "\n# ".join(lines) + "\n\nprint(os.getcwd())"))
        rows.append((100 + i, text))
        rows.append((200 + i, "\n".join(w + " x" * 40 for w in text.split())))  # too far apart
        rows.append((300 + i, lines[0]))  # the rest is in the next text
        labels[i] = (label, len(lines))
    got = {r["doc_id"]: r for r in licenses.op3_license_scan(docs(rows)).collect()}
    for i, (label, n) in labels.items():
        assert label in got[i]["labels"].split(",") and got[i]["score"] == 1.0
        assert set(got[100 + i]["labels"].split(",")) <= set(got[i]["labels"].split(","))
        assert got[200 + i]["labels"] == "" and got[200 + i]["score"] == 0.0
        if n > 1:
            assert got[i]["n_blocks"] >= 1
    words = licenses.TEMPLATES[7][1].split()
    wrapped = " ".join(words[:9]) + "\n" + " ".join(words[9:-1])  # one word is missing
    r = licenses.op3_license_scan(docs([(1, wrapped), (2, wrapped.replace("\n", " "))])).collect()
    assert r[0]["labels"] == r[1]["labels"] == "bsd" and r[0]["score"] == r[1]["score"] < 1


def test_rows_without_an_id_and_repeated_rows(docs):
    """Every row has its own result: NULL ids and copies are scanned like others."""
    text = licenses.TEMPLATES[0][1] + "\nall rights reserved"
    got = licenses.op3_license_scan(docs([(None, text), (None, "x"), (4, text), (4, text), (5, None)])).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_base"]) for r in got) == [(False, 4, 1), (False, 4, 1), (False, 5, 0), (True, 0, 0), (True, 0, 1)]
    assert len({(r["labels"], r["score"], r["n_words"]) for r in got if r["n_base"]}) == 1
