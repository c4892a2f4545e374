from __future__ import annotations

import hashlib
import random
import time

import numpy as np
from tests_llm import ODD_TEXTS, documents

from acadmetric.llm.common import vocabulary_file
from acadmetric.llm.extraction import Page, extract_pages, host_paths
from acadmetric.llm.piece_transducer import Transducer, decode, encode, round_trips
from acadmetric.llm.spot_signatures import _prefixes, alike_groups, compared_with_edits, fingerprints, likeness, signatures, spaced
from acadmetric.llm.tokens import LETTERS, Words

PIECES = vocabulary_file("piece_bpe_32k.model")


def test_page_without_its_furniture():
    html = """<html><head><title>T</title></head><body class="with-sidebar"><header><h1>Site</h1></header>
      <div class="cookie-notice">We use cookies</div><div id=main class="content c12"><h1>Head &amp; line</h1>
      <p>One<br>two  three <b>bold</b> &lt;x&gt;<p>Four <a href=x>linked</a> words here<ul><li>a<li>b</ul>
      <div class=comments><p>first!</div><form>Name<input></form><table><tr><td>c1<td>c2</table></div>
      <aside>side</aside><script>if(a<b){"</p>"}</script><footer>f</footer>"""
    assert Page(html).extract(None) == "Head & line\nOne two three bold <x>\nFour linked words here\na\nb\nc1\nc2"


def test_hosts_vote_and_pages_follow(spark):
    page = "<html><body><nav><a href=a>home</a></nav><div class='story s{n}'><p>{text}</p></div><div class=box><p>{side}</p></div></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(n=i, text="long running text " * 9, side="x")) for i in range(5)]
    rows += [(9, "http://h.example/9", page.format(n=9, text="short", side="a longer box of other things " * 5)), (10, None, None),
             (11, "http://h.example/11", ""), (12, "nonsense", "plain words")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [(r.host, r.path) for r in host_paths(pages).collect() if r.host == "h.example"] == [("h.example", "/html/body/div.s.story")]
    got = {r.page_id: r.text for r in extract_pages(pages).collect()}
    assert got[9] == "short" and got[10] == got[11] == "" and got[12] == "plain words" and len(got) == 9
    assert extract_pages(pages.limit(0)).count() == 0


def test_odd_markup_does_not_stop():
    draw = random.Random(8)
    for _ in range(300):
        html = "".join(draw.choice(["<", ">", "<p", "<!--", "-->", "</div>", "<div class='ad", "'", '"', "<script>", "</script", "a", " ", "&lt", "<li>", "/"])
                       for _ in range(40))
        assert isinstance(Page(html).extract(None), str)


def article(before: str, after: str = "") -> str:
    return f"<html><body>{before}<h1>Head</h1><p>{'running text ' * 20}</p>{after}</body></html>"


def test_hidden_parts_are_read_from_attributes():
    want = Page(article("<div>", "</div>")).extract(None)
    for seen in ("<div class='md:flex hidden lg:block'>", "<div style='overflow: hidden !important'>", "<div title='the hidden door'>", "<div data-hidden=1>",
                 "<div aria-hidden=false>", "<div id='x' data-x=\"style='display:none'\">"):
        assert Page(article(seen, "</div>")).extract(None) == want
    for unseen in ("hidden", "hidden=''", "style='color:red; display : none'", "style=display:none!important", "aria-hidden='TRUE'", "STYLE='visibility:hidden;'"):
        assert Page(article(f"<div {unseen}>secret</div>")).extract(None) == want


def test_a_form_around_the_page_is_no_form():
    plain = "<html><body>{}<div class=story><p>{}</p><p>{}</p></div>{}</body></html>"
    text = ("first part " * 30, "second part " * 30)
    want = "\n".join(t.strip() for t in text)
    assert Page(plain.format("<form id=aspnetForm><input type=hidden>", *text, "<label>Name</label><select><option>one</select></form>")).extract(None) == want
    assert Page(plain.format("<form><p>Your name</p><input></form>", *text, "<form><p>Send us a word</p></form>")).extract(None) == want
    assert Page(article("<form>", "<label>Name</label></form>")).extract(None) == Page(article("")).extract(None)


def test_odd_markup_takes_time_and_memory_in_proportion():
    import time
    import tracemalloc

    million = 1 << 20
    pages = ["<a '" * (million // 4), "<a '>'" * (million // 6), "<!" * (million // 2), "<" * million, "<a " + "x" * million, "<a x=" * (million // 5),
             "<b><div>" + "<span class=x>" * 20_000 + "</b>" * 100_000, "<li>" * 100_000 + "</p>" * 100_000, "<a \"" + "<a '" * (million // 4),
             "<p " + "a b " * (million // 4) + ">", "<!--" * (million // 4), "<script>" * (million // 8)]
    for html in pages:
        begin = time.process_time()
        assert isinstance(Page(html).extract("/html/body/div"), str)
        assert time.process_time() - begin < 8, html[:20]
    tracemalloc.start()
    deep = Page("<span class=x>" * 60_000 + "text")
    assert deep.extract(deep.path(30_000)) == "text" and tracemalloc.get_traced_memory()[1] < 200 * million
    tracemalloc.stop()


def test_pieces_are_the_librarys(spark, odd, empty):
    from sentencepiece import SentencePieceProcessor

    library, machine, draw = SentencePieceProcessor(model_file=PIECES), Transducer(PIECES), random.Random(6)
    parts = ["the", "ing", "er", " ", "  ", "tion", "1", "20", "{", "▁", "▁▁", "()", "ß", "を", "漢", "\U0001F600", "\n", "\t", "<0x0A>", "<unk>", "é"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(1500)] + [t or "" for _, t in ODD_TEXTS]
    ids = machine.encode(texts)
    assert all(x.tolist() == library.encode(t) for x, t in zip(ids, texts, strict=True))
    assert all(machine.decode(x) == library.decode(x.tolist()) for x in ids)
    back = {r.doc_id: r.text for r in decode(encode(odd, PIECES), PIECES).collect()}
    assert back[1] == "" and back[8] == dict(ODD_TEXTS)[8]
    assert all(r.same for r in round_trips(odd, PIECES).collect()) and round_trips(empty, PIECES).count() == 0


def stored_model(folder, model) -> str:
    path = folder / "own.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def given_model():
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(PIECES, "rb") as file:
        model.ParseFromString(file.read())
    return proto, model


def test_unigram_paths_are_the_librarys_and_the_least(tmp_path):
    from sentencepiece import SentencePieceProcessor

    proto, model = given_model()
    draw, kinds = random.Random(3), proto.ModelProto.SentencePiece
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    kept = [p for p in model.pieces if p.type != kinds.NORMAL or p.piece == "▁" or len(p.piece) <= 4 and (p.piece in "abcdefghijklmnopqrstuvwxyz0123456789" or draw.random() < 0.7)]
    for p in kept:
        if p.type == kinds.NORMAL:
            p.score = -draw.randrange(1 << 16) / 4096  # sums of a few are exact in the library's single precision
    del model.pieces[:]
    model.pieces.extend(kept)
    path = stored_model(tmp_path, model)
    library, machine = SentencePieceProcessor(model_file=path), Transducer(path)
    parts = ["the", "ing", "er", " ", "  ", "tion", "1", "20", "▁", "ß", "を", "漢", "\U0001F600", "\n", "é", "a", "b", "st"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(1000)]
    ids = machine.encode(texts)
    assert sum(x.tolist() == library.encode(t) for x, t in zip(ids, texts, strict=True)) == len(texts)
    assert all(machine.decode(x) == library.decode(x.tolist()) for x in ids)

    def least(word: str) -> float:
        """The least weight of all ways to cut a word, one by one."""
        if not word:
            return 0.0
        ways = [machine.weight[machine.number[word[:k]]] + least(word[k:]) for k in range(1, len(word) + 1) if word[:k] in machine.number]
        return min(ways)

    for word in ("stations", "theater", "1920s", "resting", "bitterness"):
        ids = machine.encode([word])[0].tolist()
        assert not set(ids) & set(machine.byte.values()) and sum(machine.weight[i] for i in ids) == least("▁" + word)


def test_merged_neighbours_leave_one_path():
    machine, draw = Transducer(PIECES), random.Random(4)
    words = ["▁" + "".join(draw.choice("aeinrst") for _ in range(draw.randint(1, 9))) for _ in range(300)]

    def paths(word: str, last: int) -> int:
        fits = [machine.number[word[:k]] for k in range(1, len(word) + 1) if word[:k] in machine.number]
        return sum(paths(word[len(machine.piece[i]):], i) for i in fits if machine.may_follow(last, i)) if word else 1

    assert all(paths(w, -1) == 1 for w in words)


def test_other_models_are_refused(tmp_path):
    import pytest

    for change in ("words", "squeezed", "no bytes", "lone"):
        proto, model = given_model()
        if change == "words":
            model.trainer_spec.model_type = proto.TrainerSpec.WORD
        elif change == "squeezed":
            model.normalizer_spec.remove_extra_whitespaces = True
        elif change == "no bytes":
            model.trainer_spec.byte_fallback = False
        else:
            model.pieces.add(piece="\u2603\u2604", score=-99999.0)
        with pytest.raises(ValueError, match="supported"):
            Transducer(stored_model(tmp_path, model))


def test_edited_texts_follow_the_order_of_ids(spark, many_ranges):
    draw = random.Random(9)
    rows = [(i * 7 % 1000, " ".join(draw.choice(["the", "of", "é", f"w{draw.randrange(99)}"]) for _ in range(draw.randint(0, 80)))) for i in range(300)]
    rows[5] = (rows[5][0], None)
    got = {r.doc_id: r for r in compared_with_edits(documents(spark, rows).repartition(5)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    assert len(got) == len(rows)
    for (i, t), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        cut = len(t) // 4
        edited = t[:len(t) - cut] + following[:cut]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
        own, other, changed = (s for s in signatures([t.encode(), following.encode(), edited.encode()]))
        assert got[i].near_edited == likeness(own, changed) and got[i].near_next == likeness(own, other)


def test_lists_edited_with_prose_stay_alike(spark):
    draw = random.Random(5)
    rows = []
    for i in range(0, 40, 2):
        rows.append((i, " ".join(f"item{draw.randrange(10**6)}" for _ in range(200))))
        rows.append((i + 1, " ".join(draw.choice(["the", "of", "and", f"w{draw.randrange(500)}"]) for _ in range(500))))
    got = [r.near_edited for r in compared_with_edits(documents(spark, rows)).collect() if r.doc_id % 2 == 0]
    assert len(got) == 20 and min(got) > 0.2


def test_signatures_depend_on_nearby_words_only():
    draw = random.Random(6)
    plain = " ".join(f"item{draw.randrange(10**6)}" for _ in range(200))
    for common in (1, 12, 13, 40, 400):
        whole, own = signatures([f"{plain} {'the ' * common}".encode(), plain.encode()])
        assert set(own.tolist()) <= set(whole.tolist())


def test_scripts_without_blanks_have_many_signatures(spark):
    draw = random.Random(13)
    for first, last in ((0x4E00, 0x5FFF), (0x0E01, 0x0E2E), (0x3041, 0x3096), (0x20000, 0x20400)):
        texts = ["".join(chr(draw.randint(first, last)) for _ in range(400)) for _ in range(2)]
        got = compared_with_edits(documents(spark, list(enumerate(texts)))).collect()
        assert all(r.near_edited > 0.4 and r.near_next < 0.2 for r in got)
    assert spaced("ab漢 漢字仮 é".encode()).decode().split() == ["ab", "漢", "漢字", "字仮", "é"] and spaced(b"plain") == b"plain"


def test_long_words_differ_by_the_order_of_their_bytes():
    base = "a" * 300 + "b" * 300
    words = [base, base[:-2] + "ab", base[:-2] + "ba", "b" * 300 + "a" * 300, "a" * 299 + "ba" + "b" * 299, base[:256] + "b" + base[257:513] + "a" + base[514:]]
    assert len(set(Words.of([" ".join(words).encode()], LETTERS).hash.tolist())) == len(words)
    assert Words.of([base.encode()], LETTERS).hash[0] == Words.of([f"x {base}".encode()], LETTERS).hash[1]


def test_fingerprints_of_odd_rows(odd, empty):
    got = [(r.doc_id, r.fingerprint) for r in fingerprints(odd).collect()]
    assert dict(got)[1] == dict(got)[3] == "" and dict(got)[10] and len({f for i, f in got if i in (5, 6, 7)}) == 1
    assert compared_with_edits(odd).count() == len(ODD_TEXTS) and compared_with_edits(empty).count() == 0
    single = compared_with_edits(odd.filter("doc_id = 5")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0
    assert alike_groups(empty).count() == 0
    assert {r.doc_id: r.class_id for r in alike_groups(odd).collect() if r.doc_id}.items() >= {1: 1, 2: 2, 5: 5, 6: 5, 7: 5, 10: 10}.items()


def test_alike_classes_equal_brute_force(spark, many_ranges):
    draw = random.Random(12)
    rows = []
    for family in range(3):
        words = [draw.choice(["the", "of", "and", f"w{draw.randrange(500)}"]) for _ in range(150)]
        for i in range(40):
            rows.append((family * 100 + i, " ".join(words)))
            # The second family drifts fast, so that many neighbours lie on either side of the limit; the third grows.
            for _ in range((1, 5, 2)[family]):
                words[draw.randrange(len(words))] = f"v{draw.randrange(10**6)}"
            words += [f"x{draw.randrange(10**6)}"] * (family == 2) * 6
    rows += [(990, None), (991, ""), (992, "..."), (3, rows[50][1]), (None, rows[0][1]), (None, "some words that no other text has at all")]
    sets = signatures([(t or "").encode() for _, t in rows])
    for percent in (50, 80):
        root = list(range(len(rows)))
        for a in range(len(rows)):
            for b in range(a):
                if len(sets[a]) and len(sets[b]) and likeness(sets[a], sets[b]) >= percent / 100:
                    low, high = sorted((root[a], root[b]))
                    root = [low if r == high else r for r in root]
        label = {r: min((i for (i, _), own in zip(rows, root, strict=True) if own == r and i is not None), default=None) for r in root}
        want = sorted((str(i), str(label[r])) for (i, _), r in zip(rows, root, strict=True))
        got = alike_groups(documents(spark, rows).repartition(3), percent).collect()
        assert sorted((str(r.doc_id), str(r.class_id)) for r in got) == want and len({c for _, c in want}) > 6
        assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_likeness_is_pruned_by_length():
    a, b = np.arange(10, dtype=np.uint32), np.arange(100, dtype=np.uint32)
    assert likeness(a, b, 0.5) == 0.0 and likeness(a, a) == 1.0 and likeness(a[:0], a) == 0.0 and likeness(a[:0], a[:0]) == 1.0


def test_long_fingerprints_are_cut_in_one_pass(spark):
    n = 150_000
    rows = [(i, "".join(f"{k:08x}" for k in range(i, i + n))) for i in range(2)]
    sets = spark.createDataFrame(rows, "id long, fingerprint string")
    began = time.monotonic()
    found = _prefixes(sets, 80).filter("smaller").groupBy("id", "n").count().collect()
    assert time.monotonic() - began < 30
    # n - 1 items are common; as the smaller one a set shows those of places up to n / 9, the first of which is its own item.
    assert {r.id: (r.n, r["count"]) for r in found} == {0: (n, n // 9), 1: (n, n // 9)}


def test_new_words_are_read_side_by_side_and_long_ones_forgotten():
    import sys

    from sentencepiece import SentencePieceProcessor

    library, machine, draw = SentencePieceProcessor(model_file=PIECES), Transducer(PIECES), random.Random(8)
    texts = [" ".join("".join(draw.choice("aeinrstlou\n☃漢") for _ in range(draw.randint(1, 12))) for _ in range(300)) for _ in range(10)]
    texts += ["".join(draw.choice("aeinrst") for _ in range(5000)), "漢" * 3000, "a" * 3000, "x\0y  \0 z ▁"]
    machine.encode(texts)  # works out the arcs of the pair machine
    machine.known.clear()
    machine.older.clear()
    calls = [0]

    def count(frame, event, arg) -> None:
        calls[0] += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        ids = machine.encode(texts[:10])
    finally:
        sys.setprofile(None)
    assert calls[0] < sum(map(len, texts[:10]))
    ids += machine.encode(texts[10:])
    assert [x.tolist() for x in ids] == [library.encode(t) for t in texts]
    assert max(map(len, machine.known)) < 100
