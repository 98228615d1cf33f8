"""Merkle manifest, fill-in-middle and language identification against brute force, and on rows that jobs stumble over."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from test_llm import odd

from quarrysql.llm import fim, language, merkle, queries
from quarrysql.llm.check_sql import crc32
from quarrysql.llm.common import table


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- merkle ------------------------------------------------------------------------------------


def levels_of(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path_of(levels: list[list[str]], i: int) -> list[tuple[int, list[str]]]:
    out = []
    for own in levels[:-1]:
        run = own[i // 3 * 3 : i // 3 * 3 + 3]
        out.append((i % 3, run[: i % 3] + run[i % 3 + 1 :]))
        i //= 3
    return out


def plain_manifest(rows) -> list[tuple]:
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: digest(*map(field, (r.doc_id, r.source, r.lang, r.n_chars, t)))
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        by[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    trees = {s: levels_of([leaf(r, r.text) for r in by[s]]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order]) if order else []
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            path = path_of(trees[s], i) + path_of(top, k)
            cut = r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            end = leaf(r, r.text.replace("\n", "") if cut else r.text)
            for place, others in path:
                end = digest(*others[:place], end, *others[place:])
            proof = digest(*[d for _, others in path for d in others])
            out.append((r.doc_id, trees[s][0][i], trees[s][-1][0], top[-1][0], proof, end, end == top[-1][0]))
    return sorted(out, key=repr)


def test_manifest_is_that_of_plain_trees(spark, sf):
    docs = table(spark, sf, "documents")
    found = sorted(map(tuple, queries.op11_merkle_manifest(spark, sf).collect()), key=repr)
    assert found == plain_manifest(docs.collect())
    assert any(r[-1] for r in found) and not all(r[-1] for r in found)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4], [9, 10], [242], [243, 1], [244], [486, 487], [729], [730, 5, 1], [2_188, 243 * 3]])
def test_manifest_across_blocks(spark, sizes):
    rows = [(s * 100_000 + i, f"line {i}\nof {s}", None, f"s{s}", i) for s, n in enumerate(sizes) for i in range(n)]
    random.Random(5).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert sorted(map(tuple, merkle.report(docs).collect()), key=repr) == plain_manifest(docs.collect())


def test_manifest_with_many_sources_and_many_equal_rows(spark):
    rows = [(i, "t\n", "en", f"source {i % 700}", 1) for i in range(1_500)] + [(None, "same\n", "en", "hot", 5)] * 900 + [(7, None, None, None, None)] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert sorted(map(tuple, merkle.report(docs).collect()), key=repr) == plain_manifest(docs.collect())


def test_manifest_of_odd_rows_and_none(spark):
    assert sorted(map(tuple, merkle.report(odd(spark)).collect()), key=repr) == plain_manifest(odd(spark).collect())
    assert merkle.report(odd(spark).limit(0)).collect() == []


@pytest.mark.parametrize("height", [1, 2, 5])
def test_witnesses_grow_with_appends(height):
    for n in (1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 60):
        leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
        tree = merkle.Witnesses()
        for d in leaves:
            tree.append(d)
        root, levels = tree.close(None), levels_of([d.hex() for d in leaves])
        assert root.hex() == levels[-1][0]
        for i, d in enumerate(leaves):
            assert merkle.folded(d, bytes(tree.paths[i])) == root
            assert [(p, [o.hex() for o in others]) for p, others in merkle.steps(bytes(tree.paths[i]))] == path_of(levels, i)
    tree = merkle.Witnesses()
    tree.append(leaves[0])
    assert tree.close(height).hex() == _raised(leaves[0].hex(), height)  # a block with one leaf still climbs


def _raised(h: str, times: int) -> str:
    for _ in range(times):
        h = digest(h)
    return h


def test_crc32_in_sql():
    con = duckdb.connect()
    for n in (0, 1, 42, 98765432101):
        assert con.sql(f"SELECT {crc32(str(n))}").fetchall()[0][0] == zlib.crc32(str(n).encode())


# --- fill in the middle ------------------------------------------------------------------------


def plain_fim(doc_id, text: str) -> tuple:
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in range(0, 32, 8))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    parts = f"<P>{text[:a]}", f"<S>{text[b:]}", f"<M>{text[a:b]}"
    return (n, "spm", a, b - a, parts[1] + parts[0] + parts[2]) if h4 % 100 < 20 else (n, "psm", a, b - a, "".join(parts))


def test_fim_is_that_of_slices(spark, sf):
    texts = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    rows = queries.op13_fill_in_middle(spark, sf).collect()
    assert {r.form for r in rows} == {"plain", "psm", "spm"} and len(rows) == len(texts)
    for r in rows:
        want = plain_fim(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == want[:4]
        assert r.output_sha256 == hashlib.sha256(want[4].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_fim_of_any_text_comes_back(monkeypatch):
    monkeypatch.setattr(fim, "SCAN", 7)  # texts span many scans
    r = random.Random(1)
    for i in range(3_000):
        text = "".join(r.choice(["a", "<", ">", "P", "S", "M", "é", "語", "😀", "\n", "<P", "S>", "<M"]) for _ in range(r.randrange(40)))
        n, form, prefix, middle, output = fim.transformed(str(i).encode(), text.encode())
        assert (n, form, prefix, middle, output.decode()) == plain_fim(i, text)
        assert fim.restored(output, form).decode() == text


def test_fim_of_odd_rows_and_none(spark):
    docs = odd(spark)
    for r, d in zip(sorted(fim.report(docs).collect(), key=repr), sorted(((d.doc_id, *plain_fim(d.doc_id, d.text or "")[:2]) for d in docs.collect()), key=repr)):
        assert (r.doc_id, r.n, r.form) == d
    made = fim.with_fim(docs)
    assert made.columns == [*docs.columns, "fim"]
    assert sorted(x.t for x in made.select(fim.original(made.fim.output, made.fim.form).cast("string").alias("t")).collect()) == sorted(d.text or "" for d in docs.collect())
    assert fim.report(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fim.with_fim(made)


# --- languages ---------------------------------------------------------------------------------


def test_language_of_held_out_texts(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in table(spark, sf, "documents").collect()}
    rows = queries.op12_language(spark, sf).collect()
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    own = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in own]) > 0.98


def test_language_learns_only_from_its_fold(spark, sf):
    docs = table(spark, sf, "documents").toPandas()
    held = docs.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    swapped = docs.copy()
    swapped.loc[held, "lang"] = "xx"
    a, b = (sorted(map(tuple, language.report(spark.createDataFrame(d)).collect())) for d in (docs, swapped))
    assert a == b


def test_families_come_first():
    r = random.Random(2)
    words = {"en": "the and of that", "nl": "het en van dat", "es": "el y de que", "pt": "o e da que", "zz": "qq ww xx kk"}
    names = [c for c in words for _ in range(40)]
    rows = [language.features(" ".join(r.choices(words[c].split(), k=30)).encode()) for c in names]
    model = language.fitted(rows, names)
    assert model.families.classes == ["germanic", "romance", "zz"]
    assert model.languages["romance"].classes == ["es", "pt"] and model.languages["zz"].classes == ["zz"]
    assert all(model.predict(words[c].encode())[0] == c for c in words)
    assert language.family("en-GB") == "germanic" and language.family("xx") == "xx"


def test_machine_finds_the_widest_margin():
    """Against the dual solved by projected gradient steps on the full matrix."""
    r = np.random.default_rng(4)
    dense = r.normal(size=(40, 6))
    signs = np.where(dense[:, 0] + 0.3 * r.normal(size=40) > 0, 1.0, -1.0)
    rows = [(np.arange(6), x) for x in dense]
    found = language.machine(rows, signs, cost=1.0, passes=3_000)[:6]
    kernel = (dense @ dense.T) * np.outer(signs, signs)
    share = np.zeros(40)
    for _ in range(50_000):
        share = np.clip(share - (kernel @ share - 1) / np.linalg.norm(kernel, 2), 0, 1.0)
    assert found == pytest.approx(dense.T @ (share * signs), abs=1e-3)


def test_features_do_not_depend_on_slices(monkeypatch):
    line = ("grüße aus köln " * 50).encode()
    whole = language.features(line)
    monkeypatch.setattr(language, "SLICE", 11)
    cut = language.features(line)
    assert (whole[0] == cut[0]).all() and whole[1] == pytest.approx(cut[1])
    plain = defaultdict(int)
    padded = b" " + line + b" "
    for n, spread in zip((2, 3, 4), language._SPREAD):
        for i in range(len(padded) - n + 1):
            plain[(int.from_bytes(padded[i : i + n], "big") * spread) % 2**32 >> (32 - language.BITS)] += 1
    assert list(whole[0][:-1]) == sorted(plain)
    assert whole[1][:-1] == pytest.approx([(plain[s] / sum(plain.values())) ** 0.5 for s in sorted(plain)])


def test_language_of_odd_rows_and_none(spark):
    docs = odd(spark)
    rows = language.report(docs).collect()
    assert len(rows) == 9
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (2, 3))
    assert all(r.lang_pred in ("en", "de") for r in rows if r.doc_id not in (2, 3))
    assert language.report(docs.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, "words", None), (2, "123 .,", "en")], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.report(nothing).collect()] == [("und", 0.0)] * 2
