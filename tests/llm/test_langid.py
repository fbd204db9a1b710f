import zlib

from salesmart.llm import langid, queries

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark, real):
    langs = dict(real("documents", "doc_id", "lang"))
    got = queries.op2_langid(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_awkward_rows(spark, docs_frame):
    a, b = "wort und der die das ist ein haus ", "el perro come la carne que es buena "
    rows = [(i, a * 5, "x") for i in range(20)] + [(100 + i, b * 5, "y") for i in range(20)] + [(200, None, None), (201, "", "x"), (202, "123 +++", "y"), (203, a * 3000, None), (None, b, None), (204, b, None), (204, b, None)]
    docs = docs_frame(rows)
    net = langid.fit(docs)
    got = {}
    for r in langid.identify(docs, net, "doc_id", "score", names=("p", "s")).collect():
        assert r.score == "y" and 0 <= r.s <= 1
        got.setdefault(r.doc_id, []).append(r.p)
    assert got[200] == got[201] == got[202] == ["und"]
    assert got[203] == ["x"] and got[None] == ["y"] and got[204] == ["y", "y"]
    empty = docs_frame([])
    assert langid.fit(empty) is None
    assert langid.identify(empty, None, "doc_id").collect() == []
    assert {r.lang_pred for r in langid.identify(docs, None, "doc_id").collect()} == {"und"}


def test_copies_neither_hide_nor_crowd_out_a_language(spark, docs_frame, prose, monkeypatch):
    rows = [(i, f"copy {i % 4} of x", "x") for i in range(800)] + [(1000 + i, f"text {i} of y", "y") for i in range(100)] + [(2000, "rare z", "z")]
    seen = {}
    monkeypatch.setattr(langid, "train", lambda texts, labels, seed: seen.update(texts=texts, labels=labels))
    langid.fit(docs_frame(rows), per_language=6)
    assert [seen["labels"].count(k) for k in "xyz"] == [4, 6, 1] and len(set(seen["texts"])) == 11
    first = dict(seen)
    langid.fit(docs_frame(rows[::-1]), per_language=6)
    assert seen == first


def test_pair_tables_give_the_network_s_own_answers(spark):
    texts = [bytes([65 + i % 26, 97 + i % 20, 32]) * (10 + i) for i in range(40)]
    net = langid.train(texts, ["p" if i % 2 else "q" for i in range(40)], epochs=2)
    import numpy as np

    x = np.stack([np.frombuffer(langid.cut_windows(t)[0], np.uint8) for t in texts])
    top, _ = net.pooled(x)
    z = np.maximum(top + net.bias, 0) @ net.dense + net.out
    assert np.allclose(langid._softmax(z), langid.Predictor(net).windows(x), atol=1e-4)


def test_windows_cover_the_whole_text():
    text = bytes(range(256)) * 3 + b"end"
    cut = langid.cut_windows(text)
    assert all(len(w) == langid.WINDOW for w in cut) and cut[-1].endswith(b"end") and b"".join(cut[:-1]) == text[: len(text) // 256 * 256][: len(b"".join(cut[:-1]))]
