"""License scans, collocations and token alignment against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.conftest import documents, edge_rows, sentence

from gridmart.llm import alignment, collocations, licenses

NOTICE = "Released under the MIT License."


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_matches(text, templates, percent):
    words, found = plain_words(text), set()
    for template in templates:
        own = plain_words(template.text)
        size = len(own)
        if template.is_phrase:
            found |= {(template.label, True, i, 1.0) for i in range(len(words)) if words[i : i + size] == own}
            continue
        for start in range(0, len(words), size):
            shared = len(set(own) & set(words[start : start + 2 * size]))
            if 100 * shared >= percent * len(set(own)):
                found.add((template.label, False, start, shared / len(set(own))))
    return found


def license_rows():
    dice = random.Random(3)
    rows = edge_rows()
    for i in range(80):
        template = dice.choice(licenses.PHRASES + licenses.NOTICES)
        words = template.text.split()
        for _ in range(dice.randint(0, 3)):
            words[dice.randrange(len(words))] = dice.choice(["the", "License", "odd", "MIT", ""])
        glue = dice.choice([" ", "\n", " - ", "_"])
        rows.append((1000 + i, f"{sentence(i, dice.randint(0, 9))} {glue.join(words)} {sentence(i, 5)}", "en", "a"))
    rows.append((2000, " ".join([NOTICE] * 500), "en", "a"))
    rows.append((2001, "MIT\nLicense? mit-license MITLicense cc by by cc by CC\tBY", "en", "a"))
    rows.append((2002, "the license of the public under this work " * 200, "en", "a"))
    return rows


@pytest.mark.parametrize("percent", [50, 90])
def test_licenses_are_those_of_a_plain_scan(spark, percent):
    rows = license_rows()
    templates = licenses.PHRASES + licenses.NOTICES
    found = licenses.find_licenses(documents(spark, rows), percent=percent).collect()
    expected = Counter()
    for doc_id, text, _, _ in rows:
        expected[doc_id, len(plain_words(text)), frozenset(plain_matches(text, templates, percent))] += 1
    assert Counter((r["doc_id"], r["n_words"], frozenset(map(tuple, r["matches"]))) for r in found) == expected
    assert all(len(set(r["matches"])) == len(r["matches"]) or percent < 90 for r in found)


def test_license_digest(spark, nothing):
    frame = documents(spark, [(1, f"x {NOTICE} {NOTICE}", "en", "a"), (2, None, None, None), (3, "Licensed under CC BY-NC 4.0", "en", "a")])
    rows = {r["doc_id"]: tuple(r)[1:] for r in licenses.license_digest(licenses.find_licenses(frame)).collect()}
    assert rows[1] == (11, 2, 4, 9, "mit", "mit", 1.0)
    assert rows[2] == (0, 0, None, None, "", "", 0.0)
    assert rows[3] == (7, 1, 2, 2, "cc-by", "cc-by,cc-by-nc", 1.0)
    assert licenses.license_digest(licenses.find_licenses(nothing)).count() == 0


def test_the_index_lists_the_rarest_words_only():
    counts = {b"the": 900, b"license": 500, b"under": 300, b"released": 5, b"mit": 7}
    index = licenses.TemplateIndex([licenses.Template("mit", NOTICE)], counts, 80)
    assert set(index._lists) == {b"released", b"mit"}
    with pytest.raises(ValueError):
        licenses.find_licenses(None, templates=[licenses.Template("x", "...")])


def plain_collocations(rows, least, first=2000):
    grams, totals = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = lang or "und"
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    grams[lang][tuple(words[i : i + k])] += 1
    result = []
    for lang, f in grams.items():
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= least]
        absorbed = {q for p in candidates if len(p) == 3 for q in (p[:2], p[1:]) if 100 * f[p] >= 50 * f[q]}
        ranked = []
        for p in candidates:
            if p not in absorbed:
                cuts = [(10**6 * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                ranked.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:first], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(result)


def phrase_rows():
    dice = random.Random(5)
    words = ["new", "york", "city", "of", "the", "and", "Ä", "漢字", "x\x85y", "a\xa0b", "THE", "don't"]
    rows = edge_rows()
    for i in range(300):
        text = "".join(dice.choice(words) + dice.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(30))
        rows.append((1000 + i, text, dice.choice(["en", "en", "de", None, "ö"]), "a"))
    return rows


@pytest.mark.parametrize("shard_words", [50, 1_000_000])
def test_collocations_are_those_of_plain_counts(spark, shard_words):
    rows = phrase_rows()
    found = collocations.collocations(documents(spark, rows), least=4, first=60, shard_words=shard_words)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == plain_collocations(rows, 4, 60)


def test_collocations_of_nothing(spark, nothing):
    assert collocations.collocations(nothing).count() == 0
    assert collocations.collocations(documents(spark, [(1, None, None, None), (2, " .,", "en", "a")])).count() == 0


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_phrases_of_a_shard_are_those_that_occur(depth):
    dice = np.random.default_rng(depth)
    symbols = np.concatenate([[0], dice.integers(0, 6, 400), [0]]).astype(np.int32)
    wanted = np.array([False, False, True, True, True, True])
    index = collocations.PhraseIndex(collocations.transform(symbols, depth), collocations.transform(symbols[::-1], depth))
    line = symbols.tolist()
    for length, found in enumerate(index.phrases(depth, 2), 1):
        expected = Counter()
        before, behind = Counter(), Counter()
        for i in range(len(line) - length + 1):
            phrase = tuple(line[i : i + length])
            if all(wanted[w] for w in phrase):
                expected[phrase] += 1
                before[phrase] += line[i - 1] != 0
                behind[phrase] += line[i + length] != 0
        names = list(zip(*[s.tolist() for s in found.symbols], strict=True))
        assert dict(zip(names, found.count.tolist(), strict=True)) == expected
        assert dict(zip(names, found.left.tolist(), strict=True)) == before
        assert dict(zip(names, found.right.tolist(), strict=True)) == behind


def test_contexts_that_fill_no_word_are_sorted_as_well():
    symbols = np.random.default_rng(1).integers(0, 1 << 30, 500).astype(np.int32)
    order = collocations.sorted_contexts(symbols, 3)
    contexts = [(symbols[i], symbols[(i + 1) % 500], symbols[(i + 2) % 500]) for i in order]
    assert contexts == sorted(contexts)


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 3_000_000_000_000, 7_000_000_000_001, 5_000_000_000_003  # noqa: E741
    row = spark.createDataFrame([(a, l, r)], "a bigint, l bigint, r bigint")
    score = row.select(collocations._score(row.a, row.l, row.r)).first()[0]
    assert score == 10**6 * a * a // (l * r)


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers as tokenizers_at
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizers_at.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizers_at.path("piece_bpe_32k.model"))


def plain_groups(text, libraries):
    """Ids and bytes of both sides, and the groups between shared ends."""
    if not text:
        return None
    a, b = libraries
    letters = alignment.byte_letters()
    coded = a.encode(" " + text, add_special_tokens=False)
    side_a = [(i, bytes(letters[c] for c in token)) for i, token in zip(coded.ids, coded.tokens, strict=True)]
    side_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        is_byte = re.fullmatch("<0x[0-9A-F]{2}>", piece)
        side_b.append((i, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(t for _, t in side_a) != whole or b"".join(t for _, t in side_b) != whole:
        return None
    groups, own, at_a, at_b = [], ([], []), 0, 0
    rest_a, rest_b = list(side_a), list(side_b)
    while rest_a:
        if at_a <= at_b:
            i, token = rest_a.pop(0)
            own[0].append(i)
            at_a += len(token)
        else:
            i, token = rest_b.pop(0)
            own[1].append(i)
            at_b += len(token)
        while at_b < at_a:
            i, token = rest_b.pop(0)
            own[1].append(i)
            at_b += len(token)
        if at_a == at_b:
            groups.append(own)
            own = ([], [])
    return groups


def odd_texts(n):
    dice = random.Random(8)
    parts = ["word,", "Wort!", "x...", "a<b", "don't.", *"abceéß ñ  \n\t.,'19½漢字　😀\x00\x1c\x85", " ", " ", " "] + ["<|endoftext|>", "<s>", "<0x41>", " the", " Wort", "ing", "▁"]
    return ["".join(dice.choice(parts[:-1] if i % 5 else parts) for _ in range(dice.randint(0, 30))) for i in range(n)]


def alignment_rows():
    return edge_rows() + [(1000 + i, text, "en", "a") for i, text in enumerate(odd_texts(300))]


@pytest.mark.parametrize("table_pairs", [0, 3, 200_000])
def test_alignment_is_that_of_plain_lists(spark, libraries, table_pairs):
    rows = alignment_rows()
    grouped = [(doc_id, plain_groups(text, libraries)) for doc_id, text, _, _ in rows]
    counts, most = Counter(), Counter()
    for _, groups in grouped:
        counts.update((a[-1], b[-1]) for a, b in groups or ())
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    expected = Counter()
    for doc_id, groups in grouped:
        pairs = [(a[-1], b[-1]) for a, b in groups or ()]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or ())
        expected[
            doc_id,
            sum(len(a) for a, _ in groups or ()),
            sum(len(b) for _, b in groups or ()),
            len(pairs),
            len(pairs),
            sum(counts[p] == most[p[1]] for p in pairs),
            sum(counts[p] for p in pairs),
            hashlib.sha256(text.encode()).hexdigest() if pairs else "",
        ] += 1
    found = alignment.align(documents(spark, rows), table_pairs=table_pairs)
    assert Counter(tuple(r) for r in found.collect()) == expected


def test_windows_start_at_spaces_and_hold_all_ids():
    aligner = alignment.new_aligner()
    text = "The quick brown fox, überall  und\nnirgends 漢字 x"
    a, b = aligner._a.encode(text), aligner._b.encode(text)
    windows = aligner.windows(a, b)
    assert b"".join(w for w, _ in windows) == a and b"".join(w for _, w in windows) == b
    assert len(windows) > 5
    plain = "The quick brown fox, überall und\nnirgends 漢字 x"
    list(aligner.align([plain]))
    words = alignment.apart(plain)
    own = list(zip(aligner._a.of_words(words), aligner._b.of_words(words), strict=True))
    assert own == aligner.windows(aligner._a.encode(plain), aligner._b.encode(plain))
    twice, once = aligner.align([text + " " + text, text])
    assert twice[2].startswith(once[2])


def test_alignment_of_nothing(nothing, spark):
    assert alignment.align(nothing).count() == 0
    kept = alignment.aligned_documents(documents(spark, [(1, "a b", "en", "a")]), keep=True).first()
    assert kept["groups"].count("|") == kept["n_groups"] == 2
