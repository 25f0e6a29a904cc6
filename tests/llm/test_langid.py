import random
import tracemalloc
import zlib

import numpy as np

from opskit.llm import langid

SYLLABLES = {"aa": ["ka", "to", "mi", "ra", "su"], "bb": ["schen", "ung", "pfer", "licht"], "cc": ["eau", "oux", "ère", "ç"]}


def corpus(n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = sorted(SYLLABLES)[i % 3]
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(5, 60))]
        rows.append((i, " ".join(words).title(), lang if i % 7 else None, "s"))
    return rows


def test_held_out_languages(docs):
    rows = corpus() + [(900, None, "aa", "s"), (901, "", "bb", "s"), (902, "12 !! 34\n", "cc", "s"), (903, "kato " * 60_000, "aa", "s"), (0, corpus()[0][1], "aa", "s"), (None, "schenung", "bb", "s")]
    got = langid.held_out_predictions(docs(rows)).collect()
    assert len(got) == len(rows)
    truth = {i: sorted(SYLLABLES)[i % 3] for i in range(240)}
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in truth:
            assert r.lang_pred == truth[r.doc_id]
        elif r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert next(r for r in got if r.doc_id == 903).lang_pred == "aa"


def test_labels_of_held_out_rows_teach_nothing(docs):
    held = [i for i in range(240) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = corpus()
    wrong = [(i, t, "zz" if i in held else lang, s) for i, t, lang, s in rows]
    got, want = (sorted((r.doc_id, r.lang_pred, r.score) for r in langid.held_out_predictions(docs(x)).collect()) for x in (wrong, rows))
    assert got == want


def test_cosine_matches_vectors_built_one_by_one():
    texts = ["kato mi", "schen ung schen", "x", ""]
    vectors, has = langid.document_vectors(texts, 256)
    again = [langid.document_vectors([t], 256)[0][0] for t in texts]
    assert abs(vectors - again).max() < 1e-6 and has.tolist() == [True, True, True, False]


def test_stage_keeps_recognised_documents(docs):
    rows = corpus(60) + [(900, None, "aa", "s"), (902, "12 34", "cc", "s")]
    kept = langid.keep_identified(docs(rows))
    assert kept.columns == docs([]).columns and sorted(r.doc_id for r in kept.collect()) == list(range(60))
    assert langid.keep_identified(docs([])).count() == 0


def naive(text, dimensions):
    """Letter by letter: gaps are one sign, n-grams of three with two letters at least, square roots of counts."""
    signs, counts = ["\0"], {}
    for c in text.lower():
        if c.isalpha():
            signs.append(c)
        elif signs[-1] != "\0":
            signs.append("\0")
    if signs[-1] != "\0":
        signs.append("\0")
    for i in range(len(signs) - 2):
        gram = tuple(signs[i : i + 3])
        if sum(c != "\0" for c in gram) >= 2:
            counts[gram] = counts.get(gram, 0) + 1
    out = np.zeros(dimensions)
    for gram, n in counts.items():
        vector = np.ones(dimensions)
        for k, c in enumerate(gram):
            vector = vector * np.roll(langid._letter_vector(0 if c == "\0" else ord(c), dimensions).astype(float), 2 - k)
        out += n**0.5 * vector
    return out / (np.linalg.norm(out) or 1)


def test_vectors_match_n_grams_bound_letter_by_letter():
    rng = random.Random(4)
    han = "".join(chr(rng.randint(0x4E00, 0x6000)) for _ in range(5000))  # more n-grams than a block holds
    texts = ["Kato  mi, KATO!", "schen-ung 12 schen", "x", "ab", "", han, "é ç à la" * 3]
    vectors, _ = langid.document_vectors(texts, 64)
    assert abs(vectors - np.stack([naive(t, 64) for t in texts])).max() < 1e-4


def test_long_text_of_many_letters_needs_little_memory():
    rng = random.Random(5)
    han = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(200_000))
    tracemalloc.start()
    langid.document_vectors([han])
    assert tracemalloc.get_traced_memory()[1] < 250e6
    tracemalloc.stop()


def test_rows_without_an_id_are_sampled_one_by_one(docs):
    rows = [(None if lang == "aa" else i, t, lang, s) for i, t, lang, s in corpus(300)]
    assert sorted(langid.prototypes(docs(rows), sample=10)) == ["aa", "bb", "cc"]
