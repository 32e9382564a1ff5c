from __future__ import annotations

import random
import re

from tests.conftest import CHECK_FOLDER
from tests.llm.helpers import awkward, documents, empty
from tidewatch.llm.common import table
from tidewatch.llm.licenses import BASE_PHRASES, NOTICES, Scanner, edits_of, license_digest, scan_licenses, seeds_of
from tidewatch.llm.queries import LLM_QUERIES

PHRASES = {**BASE_PHRASES, **NOTICES}


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def base_places(words):
    return sorted(
        (i, label) for p, label in BASE_PHRASES.items() for i in range(len(words))
        if words[i : i + len(p.split())] == p.split()
    )


def fuzzy_labels(words):
    """Labels of all phrases that some run of whole words is close enough to."""
    found = set()
    for phrase, label in PHRASES.items():
        n, room = len(phrase.split()), edits_of(phrase)
        for i in range(len(words)):
            for m in range(max(1, n - room), n + room + 1):
                run = " ".join(words[i : i + m])
                if abs(len(run) - len(phrase)) <= room and distance(run, phrase) <= room:
                    found.add(label)
    return found


def digest(df):
    return sorted((tuple(r) for r in license_digest(scan_licenses(df)).collect()), key=repr)


def brute(rows):
    out = []
    for doc_id, text in rows:
        words = words_of(text)
        places = base_places(words)
        starts = [i for i, _ in places]
        out.append((
            doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})), ",".join(sorted(fuzzy_labels(words))),
        ))
    return sorted(out, key=repr)


def edited(rng, text, n):
    for _ in range(n):
        i, c = rng.randrange(len(text)), rng.choice("abcxyz é")
        text = rng.choice([text[:i] + text[i + 1 :], text[:i] + c + text[i:], text[:i] + c + text[i + 1 :]])
    return text


def test_seeds_cover_every_phrase():
    for phrase in PHRASES:
        assert "".join(s for _, s in seeds_of(phrase)) == phrase
        assert len(seeds_of(phrase)) == edits_of(phrase) + 1


def test_edited_phrases(spark):
    rng, texts = random.Random(8), []
    for i in range(250):
        phrase = rng.choice(sorted(PHRASES))
        parts = [edited(rng, phrase, rng.randint(0, edits_of(phrase) + 2)) for _ in range(rng.randint(1, 2))]
        texts.append("Ab 12 " + rng.choice([" ", ", ", "\n\n- "]).join(p.replace(" ", rng.choice([" ", ".  ", "\n"])).upper() for p in parts) + rng.choice(["", "!", " é of"]))
    texts += ["cc by cc-by CC by, cc byx xcc by", "general public license general public license", "cc", "", None]
    texts += ["all rights reserved all rights reserve all right reserved", "GNU Lesser General Public Licence"]
    assert [r[:7] for r in digest(documents(spark, texts))] == brute(list(enumerate(texts)))


def test_spans():
    scanner = Scanner(PHRASES)
    n, found = scanner.scan("Æ (c) 2020: ALL-Rights\n reservd. Licensed CC BY!".encode())
    assert n == 9
    assert [(m["label"], m["edits"], m["word"], m["n_words"], m["text"]) for m in found] == [
        ("reserved", 1, 3, 3, "ALL-Rights\n reservd"), ("cc-by", 0, 7, 2, "CC BY"),
    ]


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    plain = [(i, t) for i, t in rows if t is None or len(t) < 1000]
    assert [r[:7] for r in digest(docs) if r[1] < 1000] == brute(plain)
    assert digest(empty(spark)) == []


def test_check_table(spark):
    rows = {r["doc_id"]: r["text"] for r in table(spark, CHECK_FOLDER, "documents").collect()}
    for r in LLM_QUERIES["op1_licenses"](spark, CHECK_FOLDER).collect():
        words = words_of(rows[r["doc_id"]])
        places = base_places(words)
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == (min(places)[0] if places else None, max(places)[0] if places else None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1) >= bool(places)
