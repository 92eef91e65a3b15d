"""Column functions on small inputs."""

import pytest
from pyspark.sql import functions as F

from corpusforge.functions import pitch, titles
from corpusforge.functions import text as T


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("column", "expected"),
    [
        (lambda: T.norm(F.lit("Étude No. 5, Größe")), "etudeno5groe"),
        (lambda: T.norm_spaced(F.lit("  Ça va -- bien! ")), "ca va bien"),
        (lambda: T.sort_key(F.lit("«Ébène»")), "ebene»"),
        (lambda: T.strip_accents(F.lit("Ăâî ș")), "Aai s"),
        (lambda: T.flatten_marks(F.lit("ăâîşț")), "aâîst"),
        (lambda: T.comma_below(F.lit("şţ")), "șț"),
        (lambda: T.slug(F.lit("Città: un'ora!")), "città-unora"),
        (lambda: T.strip(F.lit("\t a b\u000b \n")), "a b"),
        (lambda: T.match_case(F.lit("étude"), F.lit("ETUDE")), "ÉTUDE"),
        (lambda: T.match_case(F.lit("étude"), F.lit("Etude")), "Étude"),
        (lambda: T.base_title(F.lit("Song (II)")), "Song"),
        (lambda: T.base_title(F.lit("Song (Variantă) (I) ")), "Song"),
        (lambda: T.base_title(F.lit("Song (IV)")), "Song (IV)"),
        (lambda: T.base_title(F.lit("Song (3)")), "Song (3)"),
        (lambda: T.meta_line(F.lit("a"), F.lit(""), F.lit(None).cast("string"), F.lit("b")), "a · b"),
        (lambda: T.meta_artist(F.lit("**Some One** · x")), "Some One"),
        (lambda: T.meta_artist(F.lit("x")), None),
        (lambda: T.meta_source(F.lit("**A** · Sursa: Book, p. 3 · y")), "Book, p. 3"),
        (lambda: T.shift_decode(F.lit("$%"), 29, {"%": "ț"}), "Aț"),
        (lambda: T.strip_tags(F.lit("<p>a <!-- x --><b>b</b><script>c</script></p>")), "a b"),
        (lambda: T.mini_markdown(F.lit("**a** [b](c) `d`")), '<b>a</b> <a href="c">b</a> <code>d</code>'),
        (lambda: T.rewrite_links(F.lit("[a](b.md) [c](http://d)"), "x/"), "[a](x/b.md) [c](http://d)"),
        (lambda: T.common_prefix(F.lit("abcd"), F.lit("abxy")), 2),
        (lambda: T.common_prefix(F.lit("ab"), F.lit("abxy")), 2),
        (lambda: T.common_prefix(F.lit(""), F.lit("a")), 0),
        (lambda: T.place_tokens(F.array(F.lit(2), F.lit(3)), F.array(F.lit("Am"), F.lit("C"))), "  Am C"),
    ],
)
def test_strings(spark, column, expected):
    assert one(spark, column()) == expected


@pytest.mark.parametrize(
    ("column", "expected"),
    [
        (lambda: T.words(F.lit("À b-c  2")), ["a", "b", "c", "2"]),
        (lambda: T.words(F.lit(None).cast("string")), []),
        (lambda: T.ngrams(T.words(F.lit("a b c d e f")), 5), ["a b c d e", "b c d e f"]),
        (lambda: T.ngrams(T.words(F.lit("a b")), 5), []),
        (lambda: T.collapse_runs(F.array(*map(F.lit, "CCGGC"))), ["C", "G", "C"]),
        (lambda: T.mark_repeats(F.array(*map(F.lit, ["[C]", "[C]", "[(C)]", "[(C)]", "[G]"]))), ["[C]", "^", "[(C)]", "[(C)]", "[G]"]),
        (lambda: T.truncate_at(F.array(F.lit("a"), F.lit("END"), F.lit("b")), "END"), ["a"]),
        (lambda: T.truncate_at(F.array(F.lit("a")), "END"), ["a"]),
        (lambda: T.dedent(F.array(F.lit("  a"), F.lit(""), F.lit("   b"))), ["a", "", " b"]),
        (lambda: T.ordered_unique(F.array(*map(F.lit, "bab"))), ["b", "a"]),
        (lambda: T.links(F.lit('<a href="x">y</a><a href="z">')), ["x", "z"]),
    ],
)
def test_arrays(spark, column, expected):
    assert one(spark, column()) == expected


def test_grammar(spark):
    check = lambda s: one(spark, T.all_tokens(F.lit(s), "^[A-G]m?$", r"^\|$"))
    assert check("Am | C G") and not check("Am word") and not check("  ") and not check("|")


# name, steps, expected
MOVES = [("B", 1, "C"), ("C", -1, "B"), ("D/F#", 2, "E/G#"), ("Am7", 0, "Am7"), ("Db", 0, "Db"), ("N.C.", 3, "N.C."), ("A6/9", 2, "B6/9"), ("C/E7", 2, "D/F#7"), ("Db", 12, "C#"), ("Cb", 12, "B"), ("Am:", 3, "Cm:")]


@pytest.mark.parametrize(("name", "steps", "expected"), MOVES)
def test_transpose(spark, name, steps, expected):
    assert one(spark, pitch.transpose(F.lit(name), F.lit(steps), F.lit(False))) == expected


SHIFTS = [("x02210", 3, "x35543"), ("x02210", -9, "x35543"), ("320003", -1, "edbbbe"), ("x54230", -1, None), ("x02210", 0, "x02210")]


@pytest.mark.parametrize(("shape", "steps", "expected"), SHIFTS)
def test_shift_shape(spark, shape, steps, expected):
    assert one(spark, pitch.shift_shape(F.lit(shape), F.lit(steps))) == expected


def test_transpose_there_and_back(spark):
    rows = spark.createDataFrame([(n + q, k) for n in pitch.SHARPS for q in ("", "m7") for k in range(12)], "c string, k int")
    there = pitch.transpose(F.col("c"), F.col("k"), F.lit(False))
    assert rows.filter(pitch.transpose(there, -F.col("k"), F.lit(False)) != F.col("c")).count() == 0


def test_interval_range(spark):
    rows = spark.range(12).alias("a").select(F.col("id").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("b"))
    found = {r.i for r in rows.select(pitch.interval(F.col("a"), F.col("b")).alias("i")).collect()}
    assert found == set(range(-5, 7))


def test_sounded_and_fits(spark):
    strings = [4, 9, 2, 7, 11, 4]
    assert one(spark, pitch.sounded(F.lit("x02210"), strings)) == [0, 4, 9]
    assert one(spark, pitch.fits(F.lit("x02210"), strings, F.array(*map(F.lit, [9, 0, 4])), F.array(F.lit(4))))
    assert not one(spark, pitch.fits(F.lit("x02210"), strings, F.array(*map(F.lit, [9, 1, 4])), F.array(F.lit(4))))


def test_chains_of_plainer_names(spark):
    guitar = lambda c: one(spark, pitch.guitar_keys(F.lit(c)))
    assert guitar("Bbm7/D:") == ["A#m7/D", "A#m7"] and guitar("CaddG/E.") == ["C/E", "C"] and guitar("G7/4") == ["G7/4", "G7sus4"]
    assert guitar("D5") == ["D5", "D"] and guitar("D4") == ["D4", "Dsus4"] and guitar("F#mdim") == ["F#mdim", "F#mdim7", "F#m"] and guitar("C7+") == ["C7+", "C7aug", "C7"] and guitar("N.C.") == ["N.C"]
    assert one(spark, pitch.ukulele_keys(F.lit("Bm4"))) == ["Bm4", "Bmsus4"] and one(spark, pitch.ukulele_keys(F.lit("Bdim/F"))) == ["Bdim/F", "Bdim", "Bdim7"]
    assert one(spark, pitch.catalogue_keys(F.lit("C#dim/G"))) == ["C#dim/G", "C#dim", "C#dim7", "C#", "Dbdim/G", "Dbdim"]


def test_recase():
    assert titles.recase("THE KING OF LONDON", {}, True) == "The King of London"
    assert titles.recase("Don't stop the king", {}, True) == "Don't Stop the King"
    assert titles.recase("DE MARIA XV", {"maria": "Maria"}, False) == "De Maria XV"
    assert titles.recase("Mixed Case", {}, False) == "Mixed Case"
    assert titles.recase("LA DIANEI-N CASA", {"dianei": None}, False) == "La Dianei-n casa"
    assert titles.recase("(HAI!) MANOLE", {"manole": "Manole"}, False) == "(Hai!) Manole"


def test_names_in_titles(spark):
    words = spark.createDataFrame([("dianei",), ("diana",), ("casa",), ("maria",), ("pentru",)], "low string")
    nouns = spark.createDataFrame([("maria", "Maria"), ("diana", "Diana"), ("pentru", "Pentru")], "word string, form string")
    found = {r.low: r.form for r in titles.names_in_titles(words, nouns, nouns.filter("word = 'diana'").select("word")).collect()}
    assert found == {"dianei": None, "diana": "Diana", "maria": "Maria"}


def test_proper_nouns(spark):
    df = spark.createDataFrame([(k, "vino la Maria acum\nMaria, Ana. Ana și CASA mea") for k in range(4)], "doc_id long, text string")
    assert [tuple(r) for r in titles.proper_nouns(df).collect()] == [("maria", "Maria", 4)]


#: By hand from the rules: name, whether flats are used as its key.
KEYS = [("F", True), ("Bb", True), ("Abm", True), ("Dm7", True), ("Dmaj7", False), ("C", False), ("F#m", False), ("Am", False), ("Cm", True), ("Em", False), ("G", False)]


@pytest.mark.parametrize(("key", "flats"), KEYS)
def test_uses_flats(spark, key, flats):
    assert one(spark, pitch.uses_flats(F.lit(key))) is flats


def test_chord_parts(spark):
    parts = lambda c: tuple(one(spark, f(F.lit(c))) for f in (pitch.root, pitch.quality, pitch.bass))
    assert parts("Am7/G") == ("A", "m7", "G") and parts("A6/9") == ("A", "6", None) and parts("Am:") == (None, None, None) and parts("H") == (None, None, None)


def test_chord_list_and_lines(spark):
    body = F.array(*map(F.lit, ["C C  G", "la la", "[Am]la [Am]lo [F]", "", "B: hey"]))
    assert one(spark, pitch.chord_list(body, "^[A-G]m?:?$")) == ["C", "G", "Am", "F"]
    assert one(spark, pitch.normalise(F.array(F.lit("Db7"), F.lit("x"), F.lit("Am/G")), F.lit(2))) == ["D#7", "Bm"]
    table = F.create_map(F.lit("Gb"), F.lit("244322"))
    assert one(spark, pitch.transpose_fingering_line(F.lit("**Label:** Em 022000 · F 133211 · Q"), F.lit(1), F.lit(False), table)) == "**Label:** Fm 133111 · F# 244322 · Q"
