"""The training-data operators on small fixtures: brute-force models, round trips, and the cases that every operator takes."""

import functools
import json
import os
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foliary.llm import decontaminate, html_text, language, licenses, near_duplicates, packing, quality, secrets, token_counts, wavelet
from foliary.llm.encoding import Encoder
from foliary.llm.spans import running, spans

WORD_BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def frame(spark, texts, schema=SCHEMA):
    return spark.createDataFrame([(i, t, "en" if i % 2 else None, None, len(t) if t is not None else None) for i, t in enumerate(texts)], schema)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in all columns, empty and very long texts, ties, repeated rows, and columns whose names clash with derived ones."""
    r = random.Random(4)
    base = " ".join(r.choices([f"word{i}" for i in range(400)], k=120))
    texts = [None, "", " \n ", base, base, base.replace("word7", "other"), "short text", "éÉ ß 中文 \x01 <|x|>", ("long " * 300_000) + base, "a" * 300_000]
    rows = [(i, t, None, None, None, "clash", 1, "x") for i, t in enumerate(texts)] + [(3, base, None, None, None, "clash", 1, "x"), (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA + ", labels string, n_words long, url string")


def operators(spark):
    items = spark.createDataFrame([(1, "word1 " * 12), (None, "only"), (3, None), (1, "word1 " * 12)], "item_id long, text string")
    return {
        "packing": lambda d: packing.pack_documents(d, WORD_BPE),
        "language": lambda d: language.identify(d, language.train(d)),
        "licenses": lambda d: licenses.scan(d),
        "tokens": lambda d: token_counts.count_tokens(d, PIECES),
        "near": lambda d: near_duplicates.near_duplicates(d),
        "keep_first": lambda d: near_duplicates.keep_first(d),
        "secrets": lambda d: secrets.scan(d),
        "redact": lambda d: secrets.redact(d),
        "contamination": lambda d: decontaminate.find_contamination(d, items),
        "decontaminate": lambda d: decontaminate.decontaminate(d, items),
        "quality": lambda d: quality.quality(d),
        "filter_quality": lambda d: quality.filter_quality(d),
        "pages": lambda d: html_text.extract(d, html_text.induce(d, source="text"), source="text", keep=("doc_id", "url")),
    }


@pytest.mark.parametrize("name", ["packing", "language", "licenses", "tokens", "near", "keep_first", "secrets", "redact", "contamination", "decontaminate", "quality", "filter_quality", "pages"])
def test_odd_and_empty_tables(spark, odd, name):
    run = operators(spark)[name]
    found, rows = run(odd).collect(), odd.count()
    if name in ("language", "licenses", "tokens", "near", "secrets", "redact", "contamination", "quality", "pages"):
        assert len(found) == rows
    if name in ("keep_first", "redact", "decontaminate", "filter_quality"):
        assert run(odd).columns == odd.columns
    assert run(odd.limit(0)).count() == 0


# 1, 5: tokens


def ids_of(text, end):
    ids = Tokenizer.from_file(WORD_BPE).encode(text or "", add_special_tokens=False).ids + [end]
    return np.array(ids, "<u4")


def encoded(encoder, texts, end=0):
    ids, offsets = encoder.encode(pa.array([t.encode() for t in texts], pa.large_binary()), end)
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def test_encoder_equals_library():
    r = random.Random(3)
    letters = "abcXYZ123 .,!?'’éÉß中文́\x01<|>#$%&\n\t  -_İſ "
    texts = ["".join(r.choices(letters, k=r.randint(0, 60))) for _ in range(2000)] + ["it's they've I'll DON'T", "<|startoftext|>x", "", "<|endoftext|>", "a\x01b", "\x01", "", ".́", "ÉTÉ été Σ", "x" * 3000 + " " + "y" * 3000]
    byte_bpe = public_tokenizers.path("byte_bpe_50k.json")  # joins blanks to words, so texts go to the library as they are
    for path, most in ((WORD_BPE, 48 << 20), (WORD_BPE, 3000), (byte_bpe, 3000)):
        library, e = Tokenizer.from_file(path), Encoder(path, most)
        for lo in range(0, len(texts), 90):
            part = texts[lo : lo + 90]
            for t, found in zip(part, encoded(e, part), strict=True):
                assert found == [*library.encode(t, add_special_tokens=False).ids, 0], t
    assert encoded(e, []) == []


def test_memory_of_the_encoder_is_bounded():
    r, e = random.Random(5), Encoder(WORD_BPE, 4 << 20)
    for _ in range(12):
        e.encode(pa.array([" ".join("".join(chr(r.randrange(0x4E00, 0x9FFF)) for _ in range(r.randint(15, 400))) for _ in range(300)).encode() for _ in range(3)], pa.large_binary()), 0)
        assert e.memo.size() < 6 << 20 and e.memo.ids.nbytes < 12 << 20


def test_packing_places_every_piece(spark):
    r = random.Random(1)
    texts = [" ".join(r.choices(["alpha", "beta", "gamma", "x1"], k=r.choice([1, 5, 40, 90, 200]))) for _ in range(150)] + [None, ""]
    rows = packing.pack_documents(frame(spark, texts).repartition(5), WORD_BPE, capacity=128, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in rows:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for d, t in enumerate(texts):
        want, pieces = ids_of(t, 0), sorted(by_doc[d], key=lambda p: p.piece)
        assert b"".join(bytes(p.ids) for p in pieces) == want.tobytes() and [p.start for p in pieces] == [128 * i for i in range(len(pieces))]
        assert all(p.ids_crc32 == zlib.crc32(bytes(p.ids)) and p.length == len(p.ids) // 4 for p in pieces) and all(p.length == 128 for p in pieces[:-1])
    total = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 128
        total += at
    best = []  # best-fit decreasing, piece by piece
    for n in sorted((p.length for p in rows), reverse=True):
        fits = [i for i, left in enumerate(best) if left >= n]
        if fits:
            i = min(fits, key=lambda i: best[i])
            best[i] -= n
        else:
            best.append(128 - n)
    assert len(by_sequence) <= len(best) and total == sum(len(ids_of(t, 0)) for t in texts)
    whole = packing.sequences(packing.pack_documents(frame(spark, texts), WORD_BPE, capacity=128, with_ids=True))
    assert whole.agg(F.sum(F.length("ids"))).first()[0] == 4 * total


def test_wavelet_access_rank_select():
    r = np.random.default_rng(2)
    for n, top in ((1, 1), (5000, 50_000), (4097, 3)):
        ids = r.integers(0, top, n).astype("<u4")
        shard = wavelet.Shard(wavelet.build(ids, [1, None], [n - n // 2, n // 2]))
        assert shard.decode().tolist() == ids.tolist() and shard.doc_ids == [1, None]
        for i in r.integers(0, n, 20).tolist():
            assert shard.access(i) == ids[i] and shard.rank(int(ids[i]), i) == int((ids[:i] == ids[i]).sum())
        for token in {int(ids[0]), top, 1 << 20}:
            assert shard.count(token) == int((ids == token).sum()) and shard.occurrences(token) == np.flatnonzero(ids == token).tolist()


def test_shards_round_trip(spark, tmp_path):
    texts = [f"text number {i} " * (i % 9) for i in range(120)] + [None, ""]
    path = str(tmp_path / "shards")
    wavelet.write_shards(frame(spark, texts).repartition(6), WORD_BPE, path, shard_ids=500)
    start = 0
    for row in wavelet.documents_of(wavelet.read_shards(spark, path)).orderBy("doc_id").collect():
        ids = ids_of(texts[row.doc_id], 2)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_shards_of_odd_tables(spark, odd, tmp_path):
    """Null and repeated ids, null, empty and very long texts: each row has its place and the ids of its own text."""
    for name, table in (("odd", odd), ("empty", odd.limit(0))):
        path = str(tmp_path / name)
        wavelet.write_shards(table, WORD_BPE, path, shard_ids=2000)
        rows = sorted(wavelet.documents_of(wavelet.read_shards(spark, path)).collect(), key=lambda x: x.start)
        given = [(-1 if x.doc_id is None else x.doc_id, *(lambda ids: (len(ids), zlib.crc32(ids.tobytes())))(ids_of(x.text, 2))) for x in table.collect()]
        assert sorted((-1 if x.doc_id is None else x.doc_id, x.n_tokens, x.ids_crc32) for x in rows) == sorted(given)
        assert [x.start for x in rows] == [sum(y.n_tokens for y in rows[:i]) for i in range(len(rows))]
        assert [-1 if x.doc_id is None else x.doc_id for x in rows] == sorted(x[0] for x in given)


# 2: language


def test_language_learns_and_holds_out(spark):
    r = random.Random(5)
    lexicon = {"en": ["the", "and", "with", "thing", "ought"], "de": ["der", "und", "nicht", "schön", "über"], "fr": ["les", "que", "eaux", "été", "où"]}
    rows = [(i, " ".join(r.choices(lexicon[k], k=60)), k) for i, k in enumerate(r.choices(list(lexicon), k=300))] + [(900, None, "en"), (901, "12 3!", "en"), (902, "中文", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {x.doc_id: x for x in language.identify(d, language.train(d), keep=("doc_id",)).collect()}
    assert sum(found[i].lang_pred == k for i, _, k in rows[:300]) >= 297
    assert [found[i].lang_pred for i in (900, 901)] == ["und", "und"] and found[902].lang_pred != "und" and all(0 <= x.score <= 1 for x in found.values())
    held = {x.doc_id: x.h for x in d.select("doc_id", language.held_out().alias("h")).collect()}
    assert all(held[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)


def test_forward_pass_equals_a_plain_one():
    r = np.random.default_rng(1)
    net = language.fit(r.integers(0, 256, (40, language.WINDOW)).astype(np.uint8), r.integers(0, 3, 40), ["a", "b", "c"], epochs=1)
    x, _, _ = language.windows(pa.array([b"A short\ttext " * 30, b"\xc3\xa9", b"z" * 600], pa.large_binary()))
    for row, found in zip(x, net.log_probabilities(x), strict=True):
        values = []
        for w, taps in zip(language.WIDTHS, net.taps, strict=True):
            for f in range(language.FILTERS):
                values.append(max(sum(float(taps[j, row[i + j], f]) for j in range(w)) for i in range(language.WINDOW - w + 1)))
        hidden = [max(v + float(b), 0) for v, b in zip(values, net.bias, strict=True)]
        z = [sum(h * float(net.weights[i, k]) for i, h in enumerate(hidden)) + float(net.offset[k]) for k in range(3)]
        want = [v - max(z) - np.log(sum(np.exp(u - max(z)) for u in z)) for v in z]
        assert np.allclose(want, found, atol=1e-3)


def test_training_sample_is_bounded_and_from_anywhere(spark, monkeypatch):
    """One window a text, at most TRAIN_DOCS a language and TRAIN_WINDOWS in all, from any part of the text; repeated rows train once."""
    rows = [(str(i), f"{'x' * 3000} middle {'y' * 3000} {i}", f"l{i % 5}") for i in range(400)] + [(None, "same row of a hot id", "l0")] * 500
    d, seen = spark.createDataFrame(rows, "doc_id string, text string, lang string"), []
    monkeypatch.setattr(language, "fit", lambda x, y, names: seen.append((x, y, names)))
    language.train(d, docs=30, most=100)
    x, y, names = seen[0]
    assert names == [f"l{i}" for i in range(5)] and len(x) <= 100 and np.bincount(y).max() <= 20
    starts = {bytes(w[:1]) for w in x}
    assert b"x" in starts and b"y" in starts
    assert sum(bytes(w).startswith(b"same row") for w in x) <= 1


# 3: pages


def page(title, paragraphs, style):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    if style == 0:
        return f"<html><body><header>Site</header><nav><ul><li><a href=/a>Menu</a></li></ul></nav><main><article><h1>{title}</h1>{body}<div class=share>Share this</div><section id=comments><p>First!</p></section></article></main><aside>Side</aside><form>Name</form><footer>© x</footer><script>var a='<p>no</p>'</script></body></html>"
    return f"<html><body><div id=a1><div>Site name of this host</div><div><a href=/>Home</a></div></div><div id=b2><div class=t><h1>{title}</h1></div><div class=q>{body}</div><div class=z>Read more news on our site every day</div></div><div id=c3>Imprint and terms of all our services</div></body></html>"


def test_template_is_learned_from_the_host(spark):
    r, rows, want = random.Random(6), [], {}
    for i in range(60):
        style = i % 2
        paragraphs = [" ".join(r.choices(["lorem", "ipsum", "dolor", "&amp;", "sit", "amet"], k=r.randint(8, 30))) + f" {i} {k}." for k in range(r.randint(1, 6))]
        rows.append((i, f"https://h{style}.example.org/p/{i}?q#f", page(f"Title {i}", paragraphs, style)))
        want[i] = "\n\n".join([f"Title {i}", *(p.replace("&amp;", "&") for p in paragraphs)])
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {x.page_id: x.text for x in html_text.extract(d, html_text.induce(d)).collect()}
    assert found == want


def test_pages_of_one_heading_are_evidence_and_copies_are_not(spark):
    r, rows, want = random.Random(8), [], {}

    def prose(i):
        return " ".join(r.choices(["lorem", "ipsum", "dolor", "sit", "amet"], k=30)) + f" {i}."

    heads = {"h1": "<div><h1>Site name</h1></div>", "div": "<div>Site name</div>"}
    for i in range(40):  # every page starts with the site's name; titles stand in h2; adverts rotate
        for k, head in enumerate(heads.values()):
            title, body = f"Title {i}", [prose(i), prose(-i)]
            html = f"<div id=a>{head}</div><div id=r>Buy now number {i % 5}</div><div id=b><h2>{title}</h2><p>{body[0]}</p><p>{body[1]}</p></div><div id=c>Imprint and terms of all our services</div>"
            rows.append((100 * k + i, f"https://s{k}.example.org/{i}", html))
            want[100 * k + i] = "\n\n".join([title, *body])
    for i in range(40):  # each article comes four times, among other adverts
        if i % 4 == 0:
            title, body = f"Title {i}", [prose(i), prose(-i)]
        html = f"<div id=a>Site name of this host</div><div id=b><h1>{title}</h1><p>{body[0]}</p><p>{body[1]}</p></div><div id=r>Buy now number {i % 7}</div>"
        rows.append((200 + i, f"https://s2.example.org/{i}", html))
        want[200 + i] = "\n\n".join([title, *body])
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {x.page_id: x.text for x in html_text.extract(d, html_text.induce(d)).collect()}
    assert found == want


def test_what_elements_say_counts_at_any_depth():
    for depth in (3, 47, 60, 300):
        html = "<div>" * depth + "<nav><p>menu</p></nav><article><h1>Title</h1><p>text of it</p><aside>advert<div><article>no</article></div></aside></article><aside>more</aside>" + "</div>" * depth
        assert html_text.content(html_text.parse(html)) == "Title\n\ntext of it", depth
    deep = html_text.parse("<nav><article>" * 3000 + "x" + "</article></nav>" * 3000)
    assert html_text.content(deep) == "" and html_text.match(html_text.skeleton(deep)[0], html_text.skeleton(deep)[0])[0] == 0


@pytest.mark.parametrize("most", [10_000, 2])
def test_hosts_of_few_pages_and_of_many(spark, monkeypatch, most):
    """Two pages tell a template; hosts beyond the bound of a broadcast give the same texts."""
    monkeypatch.setattr(html_text, "BROADCAST_HOSTS", most)
    r, rows, want = random.Random(16), [], {}
    for i in range(60):
        host = 0 if i < 40 else 1 + i % 9
        title, body = f"Title {i}", [" ".join(r.choices(["lorem", "ipsum", "dolor", "sit"], k=30)) + f" {i} {k}." for k in range(2)]
        rows.append((i, f"https://n{host}.example.org/{i}", f"<div id=a>Site name of host</div><div id=b><h1>{title}</h1><p>{body[0]}</p><p>{body[1]}</p></div><div id=c>Imprint and terms of all our services</div>"))
        want[i] = "\n\n".join([title, *body])
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {x.page_id: x.text for x in html_text.extract(d, html_text.induce(d)).collect()} == want


WRAPPERS = (
    "<form id=aspnetForm action=/>{}</form>", "<div class='page has-sidebar'>{}</div>", "<div class='no-sidebar'>{}</div>", "<div class='search-index'>{}</div>", "<div class='sidebar-left header-fixed'>{}</div>",
    "<div id=comments-open>{}</div>", "<div role=form>{}</div>", "<div class='with-banner'><form><div class='menu-open'>{}</div></form></div>",
)


def test_a_name_around_the_page_loses_no_article(spark):
    r, rows, want = random.Random(26), [], {}
    for k, wrapper in enumerate(WRAPPERS):  # each on hosts of its own
        for i in range(24):
            style = i % 2
            paragraphs = [" ".join(r.choices(["lorem", "ipsum", "dolor", "sit", "amet"], k=r.randint(8, 30))) + f" {i} {j}." for j in range(r.randint(2, 6))]
            head, body = page(f"Title {i}", paragraphs, style).split("<body>")
            rows.append((100 * k + i, f"https://h{style}-{k}.example.org/p/{i}", f"{head}<body>{wrapper.format(body.removesuffix('</body></html>'))}</body></html>"))
            want[100 * k + i] = "\n\n".join([f"Title {i}", *paragraphs])
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {x.page_id: x.text for x in html_text.extract(d, html_text.induce(d)).collect()} == want


def test_what_a_name_says_holds_where_the_prose_is_elsewhere():
    talk = "".join(f"<div class=reply><p>What reader {i} has to say about all this at some length.</p></div>" for i in range(9))
    found = lambda html: html_text.content(html_text.parse(html))
    assert found(f"<article><h1>T</h1><p>Short text.</p></article><section class=comments>{talk}</section>") == "T\n\nShort text."
    assert found(f"<h1>T</h1><p>Short text.</p><div id=comments>{talk}</div>") == "T\n\nShort text."
    assert found("<main><article><p>Long enough text of the article.</p></article></main><div class=related><article><p>Card</p></article></div>") == "Long enough text of the article."
    assert found("<form><h1>T</h1><p>Text of the page.</p><label>Name</label><input><select><option>a</option></select><button>Send</button></form>") == "T\n\nText of the page."
    assert found("<h1>T</h1><p>Text of the page.</p><form><p>Sign up</p><label>Mail</label><input></form>") == "T\n\nText of the page."


@pytest.mark.parametrize("source", ["<div>" * 200_000 + "x", "<div>" * 100_000 + "x" + "</li>" * 100_000, "<div><article>" * 100_000 + "x", "<ul><li>" * 100_000 + "x", "<p>" * 200_000 + "x", "<table><tr><td>" * 70_000 + "x", "<div class=sidebar><nav>" * 50_000 + "x", "<form><div class=comment>" * 50_000 + "</form>" * 9])
def test_deep_pages_take_seconds(source):
    began = time.time()
    parsed = html_text.parse(source)
    html_text.content(parsed)
    assert len(html_text.skeleton(parsed)[1]) == len(parsed.labels) and time.time() - began < 15


def plain_match(a, b):
    """Simple tree matching as it is defined, on (label, children): the size of the best matching."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + plain_match(x, y))
    return m[-1][-1] + 1


def test_matching_equals_the_recursive_definition():
    r = random.Random(31)

    def grown(depth):
        return (r.choice("abc"), [grown(depth - 1) for _ in range(r.randrange(4))] if depth else [])

    def told(t):
        return t[0] + (f"({' '.join(map(told, t[1]))})" if t[1] else "")

    for _ in range(300):
        a, b = ("root", [grown(3) for _ in range(3)]), ("root", [grown(3) for _ in range(3)])
        slots = html_text.match(told(a), told(b))
        used = [x for x in slots if x >= 0]
        la, lb = html_text._tree(told(a))[0], html_text._tree(told(b))[0]
        assert len(used) == len(set(used)) == plain_match(a, b)  # one to one, and as many as can be
        assert all(la[i] == lb[x] for i, x in enumerate(slots) if x >= 0)


def test_wrappers_equal_a_plain_count_of_slots(spark):
    """Constants and rotating slots of every host against counts over lists."""
    r, pages = random.Random(33), defaultdict(list)
    for i in range(90):
        k = i % 3
        adverts = f"<div class=x>Offer {r.randrange(4)}</div>" if k else ""
        pages[f"h{k}"].append(f"<div id=a><p>Site {k}</p>{adverts}</div><div id=b><h1>Title {i}</h1><p>{'word ' * r.randint(20, 40)}{i}</p><p>{'more ' * r.randint(5, 30)}{i}</p></div><div id=c>Imprint</div>")
    d = spark.createDataFrame([(f"http://{h}/", x) for h, own in pages.items() for x in own], "url string, html string")
    found = {w["host"]: w for w in html_text.induce(d).collect()}
    for host, own in pages.items():
        parsed = [html_text.parse(x) for x in own]
        shapes = [html_text.skeleton(p) for p in parsed]
        count = defaultdict(int)
        for s, _ in shapes:
            count[s] += 1
        reference = max(count, key=lambda s: (count[s], s))
        seen = defaultdict(lambda: defaultdict(set))
        for i, (p, (shape, places)) in enumerate(zip(parsed, shapes)):
            slots = html_text.match(shape, reference)
            for node, text, *_ in p.blocks:
                if slots[places[node]] >= 0:
                    seen[slots[places[node]]][text].add(i)
        constant = {(slot, html_text._hash(t)) for slot, texts in seen.items() for t, on in texts.items() if len(on) >= html_text.CONSTANT * len(own)}
        rotating = {slot for slot, texts in seen.items() if sum(map(len, texts.values())) >= html_text.LEAST_PAGES and sum(len(on) for on in texts.values() if len(on) > 1) >= html_text.ROTATING * sum(map(len, texts.values()))}
        assert found[host]["reference"] == reference and found[host]["rows"] == len(own)
        assert {(c["slot"], c["hash"]) for c in found[host]["constant"]} == constant and set(found[host]["template"]) == rotating


def test_parser_and_matching():
    p = html_text.parse("<p><b>one<br>two<p>three&nbsp;&lt;x&gt;<ul><li>a<li>b<ul><li>c</ul></ul><!-- <p>no --><script>'</p>'</script>x < y")
    assert [b[1] for b in p.blocks] == ["one two", "three <x>", "a", "b", "c", "x < y"]
    assert html_text.content(html_text.parse("")) == "" and html_text.content(html_text.parse("<div>" * 5000 + "deep")) == "deep"
    a, b = "root(x(p q) y z)", "root(x(q) w z)"
    assert html_text.match(a, b) == [0, 1, -1, 2, -1, 4]
    shape, places = html_text.skeleton(html_text.parse("<div><p>a</p><p>b</p></div><div><p>c</p></div><h1>t</h1>"))
    assert shape == "root(div(p) h1)" and places == [0, 1, 2, 2, 1, 2, 3]


# 4, 8: scans


def test_licenses_base_and_labels(spark):
    texts = ["Released under the MIT License. Apache\nLicense, Version 2.0", "cc BY-sa 4.0", "permit license", "GNU  General Public License v3 or gpl-2.0", None, "x licensed under gpl y", "SPDX-License-Identifier: Apache-2.0"]
    rows = licenses.scan(frame(spark, texts)).orderBy("doc_id").collect()
    for t, row in zip(texts, rows, strict=True):
        w = words(t)
        at = [(i, label) for phrase, label in licenses.PHRASES.items() for n in [len(phrase.split())] for i in range(len(w) - n + 1) if w[i : i + n] == phrase.split()]
        assert (row.n_words, row.n_base) == (len(w), len(at)) and row.first_word == min((i for i, _ in at), default=None) and row.last_word == max((i for i, _ in at), default=None)
        assert row.base_labels == sorted({k for _, k in at}) and set(row.base_labels) <= set(row.labels) and 0 <= row.score <= 1
    assert rows[0].labels == ["apache", "apache-2.0", "mit"] and "gpl-3" in rows[3].labels and rows[6].labels == ["apache-2.0"] and rows[2].labels == []


NOTICES = [
    "Permission is hereby granted, free of charge, to any person obtaining a copy\n of this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO",
    " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions are met:\n * 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n * Neither the name of the X nor the names of its contributors may be used to endorse or promote products derived from this software",
    "# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation; either version 2 of the License, or\n# (at your option) any later version.",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "Copyright (c) 2019 Someone. All rights reserved. Unauthorized copying of this file is strictly prohibited.",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. MIT license, gpl-2.0, cc by-sa 4.0",
    "This is free and unencumbered software released into the public domain.",
    "prose about a warranty and a public license of no kind",
]


def test_license_wording_and_suppression_equal_brute_force(spark):
    rules = licenses.rules()
    assert len(rules) > 400 and all(any(k.strip() in r for k in [keyword]) for _, _, keyword, r in licenses.WORDING) and all(any(g in r for g in licenses.WORDING_GATES) for _, _, _, r in licenses.WORDING)
    texts = [*NOTICES, "\n".join(NOTICES), " ".join(NOTICES[3:6] * 5), None]
    for t, row in zip(texts, licenses.scan(frame(spark, texts)).orderBy("doc_id").collect(), strict=True):
        blank = (t or "").translate(str.maketrans("\t\n\x0b\x0c\r", " " * 5))
        found = {(label, priority, m.start(), m.end()) for label, priority, _, _, p in rules for m in re.finditer(f"(?i){p}", blank)}

        def void(x):
            return any(y[2] <= x[2] and x[3] <= y[3] and (y[1] > x[1] or y[1] == x[1] and ((y[3] - y[2], x[0]) > (x[3] - x[2], y[0]))) for y in found)

        assert {tuple(x) for x in row.detections} == {x for x in found if not void(x)}, t
    labels = [set(row.labels) for row in licenses.scan(frame(spark, NOTICES)).orderBy("doc_id").collect()]
    assert "mit" in labels[0] and {"bsd", "bsd-3-clause"} <= labels[1] and "gpl-2-or-later" in labels[2] and "apache-2.0" in labels[3] and "proprietary" in labels[4] and "mpl-2.0" in labels[5] and "unlicense" in labels[6] and not labels[7]


def test_markov_ratio_on_what_never_trained():
    """Precision and recall on names of the standard library and on random strings from other seeds and alphabets."""
    ratio, states = secrets.ratios(), secrets._STATES

    def is_secret(s):
        at = [0, *(secrets.ALPHABET.index(c) + 1 for c in s)]
        return sum(ratio[a * states + b] for a, b in zip(at, at[1:], strict=False)) >= secrets.MARGIN * len(s)

    modules = ["asyncio", "ast", "http.client", "logging", "multiprocessing", "os", "signal", "socket", "ssl", "subprocess", "tarfile", "threading", "unittest", "urllib.request", "xml.dom.minidom", "zipfile", "tkinter", "errno", "email.message", "inspect"]
    names = set()
    for m in modules:
        try:
            module = __import__(m, fromlist=["x"])
        except ImportError:
            continue
        names |= {n for x in [module, *vars(module).values()] for n in dir(x) if len(n) >= secrets.TOKEN_CHARS and set(n) <= set(secrets.ALPHABET) and not n.startswith("__")}
    assert len(names) > 500 and sum(map(is_secret, names)) <= len(names) / 50
    r = random.Random(2024)
    for letters in (secrets.ALPHABET[:64], secrets.ALPHABET[:62], secrets.ALPHABET[:52], secrets.ALPHABET[26:62]):
        for length in (16, 20, 40):
            assert sum(is_secret("".join(r.choices(letters, k=length))) for _ in range(500)) >= 475


def test_many_matches_in_one_text_take_seconds(spark):
    began = time.monotonic()
    texts = [" ".join("deadbeef" * 2 + f"{i:06x}" for i in range(20_000)), "the MIT License of it\n" * 4000]
    d = frame(spark, texts)
    found = secrets.scan(d).orderBy("doc_id").select(F.size("secrets").alias("n")).collect()
    assert found[0].n == 20_000 and licenses.scan(d).orderBy("doc_id").collect()[1].n_base == 4000
    clean = secrets.redact(d).orderBy("doc_id").first().text
    assert clean == " ".join(["[SECRET]"] * 20_000)
    assert time.monotonic() - began < 60


def test_running_and_spans_equal_plain_ones(spark):
    r = random.Random(17)
    for n in (0, 1, 2, 7, 64, 65):
        values = [r.randint(-9, 9) for _ in range(n)]
        d = spark.createDataFrame([(values, "".join(r.choices("aé1 ", k=3 * n)))], "v array<long>, t string")
        row = d.select(running(F.col("v"), lambda a, b: a + b).alias("sum"), running(F.col("v"), F.greatest).alias("top"), spans(F.col("t"), F.lit("[aé]+")).alias("s"), "t").first()
        assert row["sum"] == [sum(values[: i + 1]) for i in range(n)] and row.top == [max(values[: i + 1]) for i in range(n)]
        assert [tuple(x) for x in row.s] == [(m.start(), m.end(), m.group()) for m in re.finditer("[aé]+", row.t)]


def test_columns_of_any_name_survive(spark):
    names = ["cut", "secrets", "spans", "__text", "__clean", "__drop", "__kept", "__0", "f1", "label", "root", "detections", "n_hit"]
    d = spark.createDataFrame([(1, "password: abcdefghij1234 " + " ".join(f"word{i} of" for i in range(60)), None, "s", 3, *names), (2, None, None, None, None, *[None] * len(names))], SCHEMA + ", " + ", ".join(f"{n} string" for n in names))
    items = spark.createDataFrame([(1, "of word1 of word2")], "item_id long, text string")
    for run in (secrets.redact, quality.filter_quality, near_duplicates.keep_first, lambda x: decontaminate.decontaminate(x, items)):
        out = run(d)
        assert out.columns == d.columns and [out.where("doc_id = 1").first()[n] for n in names] == names
    assert "[SECRET]" in secrets.redact(d).where("doc_id = 1").first().text


def test_secrets_and_redaction(spark):
    token = "Zk3vQ9xL2mP7tR4wB8nC"
    texts = [f"password = '{'a1' * 8}' and AKIA{'B2' * 8}", f"see {token} here", "the_long_identifier_name_of_2023", "deadbeef" * 3 + " é " + "0" * 16, f"secret: {token} token={'x' * 11}", None]
    rows = secrets.scan(frame(spark, texts)).orderBy("doc_id").collect()
    kinds = [[(s.kind, s.start, s.end) for s in row.secrets] for row in rows]
    assert kinds[0] == [("assign", 0, 28), ("hex", 12, 28), ("access", 34, 54)] and kinds[1] == [("random", 4, 24)] and kinds[2] == [] and kinds[3] == [("hex", 0, 24), ("hex", 27, 43)]
    assert kinds[4] == [("assign", 0, 28)] and kinds[5] == []
    clean = {r.doc_id: r.text for r in secrets.redact(frame(spark, texts)).collect()}
    assert clean[1] == "see [SECRET] here" and clean[2] == texts[2] and clean[5] is None


# 6: counts


def test_longest_match_equals_brute_force():
    r = random.Random(7)
    for _ in range(200):
        pieces = {b"#" + bytes(r.choices(b"ab", k=r.randint(1, 4))) for _ in range(5)} | {bytes(r.choices(b"ab", k=r.randint(1, 5))) for _ in range(5)}
        found = token_counts.Automaton(pieces, b"#")
        for _ in range(20):
            word = bytes(r.choices(b"abc#", k=r.randint(1, 14)))
            s, at, n = b"#" + word, 0, 0
            while at < len(s):
                at += next((k for k in range(6, 1, -1) if s[at : at + k] in pieces and at + k <= len(s)), 1)
                n += 1
            assert n == found.count(word)


def test_counts_of_texts(spark):
    rows = token_counts.count_tokens(frame(spark, [None, "", "the the\tcat", "x" * 500 + " the"]), PIECES).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_tokens) for r in rows[:3]] == [(0, 0), (0, 0), (3, 3)] and rows[3].n_words == 2


def test_query_of_counts_equals_greedy_pieces(spark):
    """Every document of the smallest tables, cut word by word into the longest pieces."""
    import sentencepiece

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i).encode() for i in ids}
    longest = max(map(len, pieces))

    @functools.cache
    def count(word):
        s, n = "▁".encode() + word, 0
        while s:
            k = next((k for k in range(min(longest, len(s)), 0, -1) if s[:k] in pieces), 1)
            s, n = s[k:], n + 1
        return n

    texts = {x.doc_id: (x.text or "").encode() for x in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = {x.doc_id: (x.n_words, x.n_tokens) for x in token_counts.op6_token_counts(spark, sf).collect()}
    assert found == {d: (len(t.split()), sum(map(count, t.split()))) for d, t in texts.items()}


# 7: near duplicates


def test_links_equal_brute_force(spark):
    r = random.Random(8)
    vocabulary, texts = [f"w{i}" for i in range(500)], []
    for _ in range(12):
        base = r.choices(vocabulary, k=r.choice([3, 30, 80, 150]))
        for _ in range(r.choice([1, 4, 12])):
            copy = list(base)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            texts.append(" ".join(copy))
    passage = " ".join(r.choices(vocabulary, k=60))
    texts += [passage + " " + " ".join(r.choices(vocabulary, k=60)) for _ in range(25)] + [texts[0].upper(), texts[1] + "!", None, "", "one two", "One, two"]
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    linked = [[j for j in range(len(texts)) if j != i and sets[i] and sets[j] and 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))] for i in range(len(texts))]
    root = list(range(len(texts)))
    for _ in texts:
        root = [min([root[i], *(root[j] for j in linked[i])]) for i in range(len(texts))]
    found = {x.doc_id: x for x in near_duplicates.near_duplicates(frame(spark, texts)).collect()}
    assert [found[i].class_id for i in range(len(texts))] == root
    same = [next(j for j in range(len(texts)) if words(texts[j]) == words(t)) if words(t) else i for i, t in enumerate(texts)]
    assert [found[i].copy_id for i in range(len(texts))] == same
    assert [found[i].n_links for i in range(len(texts))] == [len(x) for x in linked]
    kept = {x.doc_id for x in near_duplicates.keep_first(frame(spark, texts)).collect()}
    assert kept == set(root)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_are_judged_by_their_text_whatever_their_ids(spark, kind):
    """Ids that repeat with other texts, and none at all: links, classes and what stays follow the texts."""
    r = random.Random(12)
    a, b, c, e = (" ".join(r.choices([f"w{i}" for i in range(300)], k=60)) for _ in range(4))
    rows = [(1, a), (1, b), (2, b + " tail"), (3, a), (4, c), (4, c), (4, e), (None, e + " end"), (None, c), (None, "alone here"), (None, None), (9, None), (5, "own text of five")]
    sets = [{tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if (w := words(t)) else set() for _, t in rows]
    linked = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j] and 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))] for i in range(len(rows))]
    least = lambda ids: min((x for x in ids if x is not None), default=None)
    name = lambda i: None if i is None else i if kind == "long" else str(i)
    want = []
    for i, (d, t) in enumerate(rows):
        copies = [rows[j][0] for j in [i, *linked[i]] if sets[i] and words(rows[j][1]) == words(t)]
        want.append((name(d), name(least([d, *(rows[j][0] for j in linked[i])]) if sets[i] else d), name(least(copies) if sets[i] else d), len(linked[i])))
    given = spark.createDataFrame([(name(d), t, "x", i) for i, (d, t) in enumerate(rows)], f"doc_id {kind}, text string, f1 string, grams int")
    order = lambda x: tuple(str(v) for v in x)
    assert sorted((tuple(x) for x in near_duplicates.near_duplicates(given).collect()), key=order) == sorted(want, key=order)
    kept = near_duplicates.keep_first(given)
    assert kept.columns == given.columns
    left = sorted((str(x.doc_id), x.text or "") for x in kept.collect())
    assert left == sorted([("1", a), ("1", b), ("4", c), ("4", e), ("None", "alone here"), ("None", ""), ("9", ""), ("5", "own text of five")])


def test_blocks_count_what_one_block_counts(spark, monkeypatch):
    r = random.Random(9)
    base = r.choices([f"w{i}" for i in range(300)], k=100)
    texts = [" ".join(w if r.random() > 0.01 else "z" + str(r.random())[2:6] for w in base) for _ in range(60)]
    whole = {x.doc_id: x.n_links for x in near_duplicates.near_duplicates(frame(spark, texts)).collect()}
    monkeypatch.setattr(near_duplicates, "BLOCK_TEXTS", 7)
    assert whole == {x.doc_id: x.n_links for x in near_duplicates.near_duplicates(frame(spark, texts)).collect()}


# 9: benchmark


def test_contamination_equals_brute_force(spark):
    r = random.Random(10)
    vocabulary = [f"v{i}" for i in range(30)]
    items = [" ".join(r.choices(vocabulary, k=k)) for k in (4, 10, 11, 25, 25)] + ["", None, "solo"]
    texts = [" ".join(r.choices(vocabulary, k=40)) for _ in range(20)] + [f"pre {items[3]} post", items[1].upper(), f"{items[4][:60]} x", "solo", "so lo", None, ""]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    windows = defaultdict(set)
    for i, t in enumerate(items):
        w = words(t)
        k = min(10, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[a : a + k])].add(str(i))
    for size in (200_000, 3):
        rows = decontaminate.find_contamination(frame(spark, texts), benchmark, block_windows=size).orderBy("doc_id").collect()
        for t, row in zip(texts, rows, strict=True):
            w, hit, own = words(t), set(), set()
            for k in {len(x) for x in windows}:
                for a in range(len(w) - k + 1):
                    if tuple(w[a : a + k]) in windows:
                        hit |= set(range(a, a + k))
                        own |= windows[tuple(w[a : a + k])]
            assert row.n_words == len(w) and row["items"] == sorted(own) and {p for h in row.hits for p in range(h.start, h.end)} == hit
    clean = {x.doc_id: x.text for x in decontaminate.decontaminate(frame(spark, texts), benchmark).collect()}
    assert 20 not in clean and 21 not in clean and 23 not in clean and clean[24] == "so lo" and clean[25] is None


def test_decontaminate_gives_the_same_in_any_blocks(spark):
    def run(a, k):
        return " ".join(f"{a}{i}" for i in range(k))

    a, b = run("a", 12), run("b", 12)
    over = " ".join([*(f"a{i}" for i in range(6, 12)), *(f"c{i}" for i in range(6))])  # overlaps the end of a
    joint = " ".join([*(f"x{i}" for i in range(5)), *(f"y{i}" for i in range(5))])  # arises only where a is cut out
    benchmark = spark.createDataFrame(list(enumerate([a, b, over, joint])), "item_id long, text string").coalesce(1)
    texts = [
        f"{a} {run('p', 8)} {b} {run('q', 8)}",  # each item is 30%, both are 60%
        f"{run('p', 20)} {a} c0 c1 c2 c3 c4 c5 {run('q', 20)}",
        f"{run('p', 20)} {run('x', 5)} {a} {run('y', 5)} {run('q', 20)}",
    ]
    want = {1: f"{run('p', 20)} {run('q', 20)}", 2: f"{run('p', 20)} {run('x', 5)} {run('y', 5)} {run('q', 20)}"}
    for size in (200_000, 3, 1):
        assert {x.doc_id: x.text for x in decontaminate.decontaminate(frame(spark, texts), benchmark, block_windows=size).collect()} == want


def test_rows_of_one_id_keep_their_own_hits_in_any_blocks(spark):
    benchmark = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, "delta")], "item_id long, text string")
    d = spark.createDataFrame([(None, "x gamma"), (None, "y"), (7, "alpha beta z"), (7, "delta"), (7, "delta")], "doc_id long, text string")
    want = sorted([("None", 2, ["2"], [(1, 2)]), ("None", 1, [], []), ("7", 3, ["1"], [(0, 2)]), ("7", 1, ["3"], [(0, 1)]), ("7", 1, ["3"], [(0, 1)])])
    for size in (200_000, 1):
        rows = decontaminate.find_contamination(d, benchmark, block_windows=size).collect()
        assert sorted((str(x.doc_id), x.n_words, x["items"], [(h.start, h.end) for h in x.hits]) for x in rows) == want


# 10: quality


def thue_morse(n):
    own = "a"
    while len(own) < n:
        own += own.translate(str.maketrans("ab", "ba"))
    return own[:n], own[:n].translate(str.maketrans("ab", "ba"))


def test_words_built_to_collide_are_told_apart(spark):
    """Sums of letters times powers are equal for these pairs of words, whatever the (odd) base."""
    texts, dup = [], []
    for n in (64, 65, 1024, 2048, 4096):
        one, two = thue_morse(n)
        texts += [one, two, f"some words {one} and more of them", f"some words {two} and more of them", "\n".join([one, two, one]), two + "\n" + one]
        dup += [0, 0, 0, 0, 1, 0]
    d = frame(spark, texts)
    assert {x.doc_id: (x.class_id, x.n_links) for x in near_duplicates.near_duplicates(d).collect()} == {i: (i, 0) for i in range(len(texts))}
    assert sorted(x.doc_id for x in near_duplicates.keep_first(d).collect()) == list(range(len(texts)))
    assert [x.n_dup_lines for x in quality.quality(d).orderBy("doc_id").collect()] == dup


def test_lines_of_one_hash_are_held_against_each_other(monkeypatch):
    monkeypatch.setattr(quality, "hash_ranges", lambda data, start, end: np.zeros(len(start), np.uint64))
    texts = ["a\nb\na\nc\nb", "x\nx", "p\nq"]
    assert quality.base_statistics(pa.array([t.encode() for t in texts], pa.large_binary()))["n_dup_lines"].tolist() == [2, 1, 0]


def test_hash_of_ranges_depends_on_all_their_bytes_alone():
    from foliary.llm.kernels import hash_ranges

    r = random.Random(41)
    own = list({r.randbytes(r.choice([1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200])) for _ in range(3000)} | {b"\0" * k for k in range(1, 90)})
    def hashes(order, gap, seed=0):
        data, at = gap.join(order), np.cumsum([0, *(len(x) + len(gap) for x in order)])[:-1]
        return dict(zip(order, hash_ranges(np.frombuffer(data, np.uint8), at, at + np.array([len(x) for x in order]), seed).tolist()))
    h = hashes(own, b"")
    assert len(set(h.values())) == len(own)
    r.shuffle(own)
    assert hashes(own, b"--") == h and not set(hashes(own, b"", 1).values()) & set(h.values())


def test_quality_statistics_and_order(spark):
    prose = " ".join(f"word{i} sentence" for i in range(40))
    texts = [prose, "ab " * 60, "# $ % " * 40 + prose, prose.upper(), "! " * 200 + prose, ("same line here\n" * 60), "1 2 3 " * 3 + " ".join(str(i) for i in range(90)), None, "few words", "\n".join(f"line {i} of it\nline {i} of it" for i in range(30))]
    rows = quality.quality(frame(spark, texts)).orderBy("doc_id").collect()
    for t, row in zip(texts, rows, strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        seen = defaultdict(list)
        for i in range(len(w) - 2):
            seen[tuple(w[i : i + 3])].append(i)
        repeated = len({p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 3)})
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeated)
        assert row.base_failed == (len(w) < 50 or 100 * repeated > 50 * len(w)) and (not row.kept or not row.base_failed)
    assert [r.kept for r in rows[:8]] == [True, False, False, False, False, False, False, False]
    kept = quality.filter_quality(frame(spark, texts)).collect()
    assert {r.doc_id for r in kept} == {r.doc_id for r in rows if r.kept}
    assert {r.name for r in quality.order_rules(frame(spark, texts))} == {r.name for r in quality.RULES}


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(11)
    vocabulary = [f"term{i}" for i in range(2000)]
    clean = [" ".join(r.choices(vocabulary, k=80)) for _ in range(30)]
    item = " ".join(r.choices(vocabulary, k=30))
    texts = clean + [clean[0], clean[1].replace("term", "Term", 1), "junk", item, None]
    frame(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"}, name
    assert {x.doc_id for x in docs.collect()} == set(range(30))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.select("doc_id").distinct().count() == 30 and json.dumps(packed.columns)


def test_pipeline_equals_brute_force(spark, tmp_path):
    """Each stage against a plain model of it: who goes, which words are cut, what is masked, and the packed ids of what is left."""
    import corpus_pipeline

    r = random.Random(23)
    vocabulary = [f"term{i}" for i in range(3000)]
    prose = lambda k: " ".join(r.choices(vocabulary, k=k))
    bases, item, long = [prose(r.randint(60, 200)) for _ in range(12)], prose(30), prose(2500)
    texts = [*bases, *(b + " more words at the end" for b in bases[:4]), *(b.upper() for b in bases[4:8]), *(f"{prose(60)} {item} {prose(60)}" for _ in range(3)), f"{item} {prose(15)} and some more words of {prose(20)}", item, f"{prose(70)} password = abcdef012345 {prose(5)}", f"{prose(70)} Zk3vQ9xL2mP7tR4wB8nC", long, "too short", "! " * 300, None, ""]
    rows = [(i, t, "en", None, len(t) if t is not None else None) for i, t in enumerate(texts)]
    r.shuffle(rows)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = {d: t for d, t, *_ in rows}
    stage = {}
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, run in corpus_pipeline.STAGES:
        docs = run(spark, docs, str(tmp_path))
        stage[name] = docs
    # quality rules
    left = {d: t for d, t in left.items() if t and len(t.split()) >= 50 and 2 * t.count("!") <= len(t.split()) and 2 * sum(c.isupper() for c in t) <= sum(c.isalpha() for c in t)}
    assert {x.doc_id: x.text for x in stage["quality_rules"].collect()} == left
    # near duplicates: the least id of what links reach
    sets = {d: {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} for d, t in left.items() for w in [words(t)]}
    root = {d: d for d in left}
    for _ in left:
        root = {d: min([root[d], *(root[e] for e in left if 9 * len(sets[d] & sets[e]) >= 4 * (len(sets[d]) + len(sets[e])))]) for d in left}
    left = {d: t for d, t in left.items() if root[d] == d}
    assert {x.doc_id: x.text for x in stage["ngram_jaccard_join"].collect()} == left
    # decontamination: hit words go up to the next word; documents that are mostly benchmark go
    windows = {tuple(words(item)[i : i + 10]) for i in range(21)}
    for d, t in list(left.items()):
        found = [(m.start(), m.group().lower()) for m in WORDS.finditer(t)]
        hit = {p for i in range(len(found) - 9) if tuple(w for _, w in found[i : i + 10]) in windows for p in range(i, i + 10)}
        if 2 * len(hit) > len(found):
            del left[d]
        elif hit:
            ends = [*(at for at, _ in found[1:]), len(t)]
            left[d] = t[: found[0][0]] + "".join(t[at:end] for i, ((at, _), end) in enumerate(zip(found, ends, strict=True)) if i not in hit)
    assert {x.doc_id: x.text for x in stage["benchmark_decontamination"].collect()} == left
    # secrets
    left = {d: t.replace("password = abcdef012345", "[SECRET]").replace("Zk3vQ9xL2mP7tR4wB8nC", "[SECRET]") for d, t in left.items()}
    assert {x.doc_id: x.text for x in stage["secret_scans"].collect()} == left and sum("[SECRET]" in t for t in left.values()) == 2
    assert all(x.n_chars == len(x.text) for x in stage["secret_scans"].collect())
    # packing
    pieces = stage["best_fit_packing"].collect()
    want = sorted((d, k, zlib.crc32(ids[2048 * k : 2048 * (k + 1)].tobytes())) for d, t in left.items() for ids in [ids_of(t, 0)] for k in range(-(-len(ids) // 2048)))
    assert sorted((x.doc_id, x.piece, x.ids_crc32) for x in pieces) == want and max(x.piece for x in pieces) >= 1
    ends = defaultdict(int)
    for x in sorted(pieces, key=lambda x: (x.sequence_id, x.offset)):
        assert x.offset == ends[x.sequence_id]
        ends[x.sequence_id] += x.length
    assert max(ends.values()) <= 2048
