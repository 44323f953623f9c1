"""Fill-in-middle against a row-by-row version, and the way back."""

import hashlib
import random
import re

from llm_fixtures import ODD, frame

from ledgerlens.llm import fim


def by_hand(ident, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'null' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def found(df):
    rows = fim.restore(df).collect()
    return [((r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.restored) for r in rows]


def test_odd_rows(spark):
    rows = ODD + [(20, "\n"), (21, "\n\nx"), (22, "<\nS><"), (23, "a<P>\nb\nc"), (24, "é\nü\U0001f600\n"), (25, "<S")]
    out = found(fim.fill_in_middle(frame(spark, rows)))
    assert sorted(out, key=repr) == sorted(((by_hand(i, t), t or "") for i, t in rows), key=repr)


def test_random_texts_and_rates(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("ab\n\n <S>PM é") for _ in range(rng.randrange(80)))) for i in range(400)]
    for args in ((7, 100, 50), (11, 40, 0), (3, 100, 100)):
        out = found(fim.fill_in_middle(frame(spark, rows), *args))
        assert sorted(out, key=repr) == sorted(((by_hand(i, t, *args), t) for i, t in rows), key=repr)


def test_slices_do_not_matter(monkeypatch):
    import pyarrow as pa

    text = pa.array(["a\nb\n", "", "c", "d\n" * 50, "e"], pa.large_string())
    monkeypatch.setattr(fim, "SLICE_BYTES", 5)
    assert list(fim._slices(text)) == [(0, 3), (3, 1), (4, 1)]


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a\nb\n", "x", 2.5)], "doc_id bigint, text string, FORM string, extra double")
    done = fim.fill_in_middle(df)
    assert done.columns == ["doc_id", "text", "extra", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert fim.restore(done).first().restored == "a\nb\n"
    assert fim.fill_in_middle(df.limit(0)).count() == 0
