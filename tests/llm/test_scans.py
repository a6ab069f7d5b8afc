import hashlib
import random
import re
import textwrap

from helpers import docs_of

from quern.llm import licenses, queries, secrets, substrings

SF = "/root/testdata/sf0.001"


def base_spans(t):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def test_secrets_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op7_secret_scans(spark, SF).collect()}
    assert len(got) == len(texts)
    for i, t in texts.items():
        want = base_spans(t)
        listed = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == x for _, k, _ in want) for x in range(3)]
        assert not listed or set(listed.split(",")) <= set(got[i].spans.split(","))


def test_weak_parts_need_partners(spark):
    opaque = "aB3" * 10
    far = " x" * 400
    texts = [
        f"é AKIA{'Q' * 16} then {opaque}",
        f"AKIA{'Q' * 16}{far} {opaque}",
        f"{opaque} https://host.example/path",
        "client_id = some.name and token: abcdefgh12 at https://host.example/v1 end",
        "login: somebody",
        None,
        "",
        "a" * 50_000,
        "PASSWORD=short, Secret='12345678'",
    ]
    found = {r.doc_id: r for r in secrets.find_secrets(docs_of(spark, texts, [(0, texts[0], None, None, None, None, None)])).collect()}
    kinds = {i: [secrets.KINDS[s.kind] for s in r.spans] for i, r in found.items()}
    assert kinds[0] == ["access", "opaque"] and kinds[1] == ["access"] and kinds[2] == [] and kinds[3] == ["identifier", "assign", "endpoint"]
    assert kinds[4] == kinds[5] == kinds[6] == [] and kinds[7] == ["hex"] and kinds[8] == ["assign"]
    assert secrets.find_secrets(docs_of(spark, [])).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def weak_spans(t, reach):
    """The weak spans of a text, by comparing each with each."""
    base = base_spans(t)
    ids = [(m.start(), 3, m.end()) for m in secrets.IDENTIFIER.finditer(t)]
    free = lambda m: not any(s < m.end() and m.start() < e for s, _, e in base + ids)
    opaque = [(m.start(), 4, m.end()) for m in secrets.OPAQUE.finditer(t) if free(m)]
    near = lambda x, ys: any(s < x[2] + reach and e > x[0] - reach for s, _, e in ys)
    kind = lambda *ks: [x for x in base if x[1] in ks]
    linked = [x for x in opaque if near(x, kind(1) + ids)]
    out = linked + [x for x in ids if near(x, kind(0, 2) + opaque)]
    return sorted(out + [(m.start(), 5, m.end()) for m in secrets.ENDPOINT.finditer(t) if near((m.start(), 5, m.end()), kind(0, 2) + linked)])


def test_linking_against_brute_force(spark):
    rng = random.Random(12)
    parts = ["login: somebody", "aB3" * 10, "https://host.example/path", "token: abcdefgh12", f"AKIA{'Q' * 16}", "0123456789abcdef" * 2, "client_id=me.you", "wörd"]
    texts = [" ".join(rng.choice(parts) + " x" * rng.choice([0, 3, 20, 60, 99, 101, 130]) for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts += [f"login: x{' y' * 3000}{'aB3' * 10} https://host.example/path", f"{'aB3' * 10} https://host.example/path", f"login: somebody {'aB3' * 10} https://host.example/path"]
    found = {r.doc_id: r for r in secrets.find_secrets(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        assert [(s.start, s.kind, s.end) for s in found[i].spans] == sorted(base_spans(t) + weak_spans(t, secrets.REACH))
    assert not found[300].spans and not found[301].spans and len(found[302].spans) == 3


def brute_labels(w):
    """Labels of all windows of all templates over the words ``w``, but those that another label's better match covers by over half."""
    found = set()
    for label, marks, template in licenses.TEMPLATES:
        order = WORD.findall(template.lower())
        tokens = set(order)
        for i in [i for i in range(len(w)) if w[i] in tokens]:
            at = [k for k in range(i, min(len(w), i + len(order))) if w[k] in tokens]
            held = {w[k] for k in at}
            if len(held) >= licenses.CONTAINMENT * len(tokens) - 1e-9 and set(marks.split()) <= held and [w[k] for k in at].count(w[i]) == 1:
                found.add((label, len(held), i, max(min(k for k in at if w[k] == x) for x in held)))
    return {x for x, n, a, b in found if not any(y != x and m > n and 2 * (min(b, d) - max(a, c) + 1) > b - a + 1 for y, m, c, d in found)}


def test_licenses_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op3_license_scans(spark, SF).collect()}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, t in texts.items():
        w = word.findall(t.translate(lower))
        places = [(k, label) for p, label in licenses.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        labels = {x for _, x in places}
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == (min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        labels |= brute_labels(w)
        assert r.labels == ",".join(sorted(labels))


def test_license_edges(spark):
    texts = [None, "", "CC-BY cc by cc by", "released under mit license", "nothing\nhere", "x " * 20_000 + "all rights reserved", "general public\nlicense"]
    got = {r.doc_id: r for r in licenses.find_licenses(docs_of(spark, texts)).collect()}
    assert [got[i].n_base for i in range(7)] == [0, 0, 3, 0, 0, 1, 1]
    assert got[3].labels == ["mit"] and got[3].score == 0.8 and got[5].first_word == 20_000 and got[0].first_word is None
    assert licenses.find_licenses(docs_of(spark, [])).count() == 0


def test_notices_and_what_only_looks_like_one(spark):
    notices = {(label, t) for label, _, t in licenses.TEMPLATES}
    wrapped = [(label, textwrap.fill(" ".join(t.split()), 60).replace("\n", "\n * ")) for label, t in sorted(notices)]
    others = [
        ("bsd", "Released under the BSD License."),
        (None, "Licensed under the Eclipse Public License, Version 2.0."),
        (None, "The film was released in May; under it the license fee doubled."),
        ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
        ("mit", "x " * 30_000 + wrapped[-6][1] if wrapped[-6][0] == "mit" else "Released under the MIT License."),
    ]
    texts = [f"A tool.\n{t}\nint main() {{}}" for _, t in wrapped] + [t for _, t in others] + [f"{wrapped[0][1]}\n\nReleased under the MIT License."]
    got = {r.doc_id: r.labels for r in licenses.find_licenses(docs_of(spark, texts)).collect()}
    for i, (label, t) in enumerate(wrapped + others):
        method = set(got[i]) - {x for p, x in licenses.PHRASES if f" {p} " in f" {' '.join(WORD.findall(t.lower()))} "}
        assert method | set(got[i]) == set(got[i]) and set(got[i]) - {"gpl", "cc-by"} == ({label} if label else set()) - {"gpl", "cc-by"}, (label, t)
        assert label is None or label in got[i]
    assert {wrapped[0][0], "mit"} <= set(got[len(texts) - 1])


def method_labels(text):
    """What the notices alone give, without the phrases."""
    return brute_labels(WORD.findall(text.lower()))


def test_neighbours_of_licenses(spark):
    """Each notice and identifier has its own label, not that of the license whose words it shares."""
    for label, _, text in licenses.TEMPLATES:
        assert method_labels(text) == {label}, text
    said = {
        "SPDX-License-Identifier: GPL-2.0-only": {"gpl"}, "SPDX-License-Identifier: LGPL-2.1-only": {"lgpl"}, "// SPDX-License-Identifier: LGPL-3.0-or-later": {"lgpl"}, "SPDX-License-Identifier: CC-BY-SA-4.0": {"cc-by-sa"},
        "SPDX-License-Identifier: BSD-2-Clause": {"bsd"}, "SPDX-License-Identifier: Nothing-1.0": set(), "Permission is hereby granted to the library to lend this font.": set(), "This library is free; everybody can modify it.": set(),
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this font software and associated documentation files": {"font-permission"},
    }
    rows = licenses.find_licenses(docs_of(spark, list(said))).collect()
    for (t, labels), r in zip(said.items(), sorted(rows, key=lambda r: r.doc_id), strict=True):
        assert set(r.labels) == labels | set(r.base_labels), t
    assert all(method_labels(t) == labels for t, labels in said.items())


def passage(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_passages_survive_shifts(spark):
    shared = passage(0, 55)
    texts = [passage(i, 200) for i in range(1, 30)]
    texts[3] += " " + shared
    texts[9] = f"{passage(90, 31)} {shared} {texts[9]}"
    texts[11] = shared + "\n" + texts[11]
    texts += [None, "", "short", texts[5]]
    docs = docs_of(spark, texts)
    got = substrings.repeated_passages(docs).collect()
    assert {(r.doc_id, r.first_doc_id) for r in got} == {(9, 3), (11, 3), (32, 5)}
    for r in got:
        assert texts[r.doc_id].encode()[r.start : r.end] == texts[r.first_doc_id].encode()[r.first_start : r.first_start + r.end - r.start]
    assert {(r.start, r.end) for r in got if r.doc_id == 11} == {(0, len(shared))} or {r.end - r.start for r in got if r.doc_id == 11} <= {len(shared), len(shared) + 1}
    cut = {r.doc_id: r.text for r in substrings.drop_passages(docs, substrings.repeated_passages(docs)).collect()}
    assert cut[32] == "" and shared not in cut[11] and len(cut[11]) >= len(texts[11]) - len(shared) - 2
    assert substrings.repeated_passages(docs_of(spark, [])).count() == 0
    twice = docs_of(spark, [], [(7, texts[1], None, None, None, None, None), (7, texts[1], None, None, None, None, None), (None, texts[1], None, None, None, None, None), (7, texts[2] + texts[1], None, None, None, None, None)])
    got = substrings.repeated_passages(twice)
    assert {(r.doc_id or 0, r.first_doc_id) for r in got.collect()} == {(0, 7), (7, 7)}
    assert sum(len(r.text) for r in substrings.drop_passages(twice, got).collect()) < len(texts[1]) + len(texts[2]) + 2


def test_passages_of_two_sources_name_both(spark):
    one, two = passage(70, 80), passage(71, 80)
    texts = [passage(1, 60), one, two, passage(2, 60) + " " + one + two, one + two]
    joined = substrings.repeated_passages(docs_of(spark, texts)).collect()
    for doc in (3, 4):
        assert {1, 2} <= {r.first_doc_id for r in joined if r.doc_id == doc}
    assert {r.text for r in substrings.drop_passages(docs_of(spark, texts), substrings.repeated_passages(docs_of(spark, texts))).collect()} == {passage(2, 60) + " ", ""}


def test_passages_by_brute_force(spark, monkeypatch):
    """Every passage stands where it is said to; of 300 bytes that stand in an earlier document, the first that has them is named. Chunks of many places too."""
    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path)
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    got = substrings.repeated_passages(docs).collect()
    assert len(got) > 100
    for r in got:
        assert texts[r.doc_id][r.start : r.end] == texts[r.first_doc_id][r.first_start : r.first_start + r.end - r.start]
        assert r.end - r.start >= substrings.PASSAGE and (r.first_doc_id, r.first_start) < (r.doc_id, r.start)
    first, wanted = {}, set()
    for i in sorted(texts):
        for k in range(len(texts[i]) - 299):
            f = first.setdefault(hash(texts[i][k : k + 300]), i)
            if f != i:
                wanted.add((i, f))
    found = {(r.doc_id, r.first_doc_id) for r in got}
    documents = {i for i, _ in wanted}
    assert len(documents) > 50 and len(wanted & found) >= 0.98 * len(wanted) and documents <= {i for i, _ in found}
    monkeypatch.setattr(substrings, "HOT", 40)
    again = substrings.repeated_passages(docs).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_very_long_and_periodic_texts(spark):
    texts = ["ab " * 400_000, passage(5, 150_000), "x" * 300_000, "start " + passage(5, 150_000)]
    got = substrings.repeated_passages(docs_of(spark, texts)).collect()
    long = max((r for r in got if r.doc_id == 3), key=lambda r: r.end - r.start)
    assert (long.start, long.end, long.first_doc_id) == (6, len(texts[3]), 1)
    assert {r.doc_id for r in got} == {0, 2, 3} and len(got) < 20


def test_words_again_and_again(spark):
    """Stretches of one word have no usual boundary; they are found whatever stands around them, and in the first text whose stretch is as long."""
    words = lambda w, n: f"{w} " * n
    texts = [passage(1, 40) + words("the", 30) + passage(2, 40), passage(3, 33) + words("the", 140) + passage(4, 20), passage(5, 21) + words("the", 120) + passage(6, 50)]
    texts += [passage(7, 30) + words("of and", 50), words("of and", 60) + passage(8, 10), passage(9, 10) + words("la", 300), words("la", 90) + passage(10, 70)]
    docs = docs_of(spark, texts)
    got = substrings.repeated_passages(docs).collect()
    assert {(2, 1), (4, 3), (6, 5)} <= {(r.doc_id, r.first_doc_id) for r in got}
    for r in got:
        assert texts[r.doc_id].encode()[r.start : r.end] == texts[r.first_doc_id].encode()[r.first_start : r.first_start + r.end - r.start]
    assert max(r.end - r.start for r in got if r.doc_id == 2) >= 480


def test_chunks_cover_texts(spark):
    texts = ["é" * 3000, passage(1, 500), "a" * 9000, "", "x"]
    by = {}
    for r in substrings.chunks(docs_of(spark, texts)).collect():
        by.setdefault(r.id, []).append((r.start, r.size))
    for i, t in enumerate(texts):
        at = 0
        for start, size in sorted(by.get(i, [])):
            assert start == at and 0 < size <= substrings.MOST
            at += size
        assert at == len(t.encode())
