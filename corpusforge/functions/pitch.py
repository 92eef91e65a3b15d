"""Pitch arithmetic on chord names and fingerings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusforge.functions.text import let

# The twelve notes with sharps and with flats, and other spellings of them.
SHARPS = ["C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B"]
FLATS = ["C", "Db", "D", "Eb", "E", "F", "Gb", "G", "Ab", "A", "Bb", "B"]
OTHERS = {"Cb": "B", "B#": "C", "Fb": "E", "E#": "F"}
ROOT = r"^([A-G][#b]?)(.*)$"
#: A bass note is the first note behind a slash; what follows it stays.
BASS = r"^(.*?)/([A-G][#b]?)(.*)$"


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def pitches() -> dict[str, int]:
    return {n: i for names in (SHARPS, FLATS) for i, n in enumerate(names)} | {n: SHARPS.index(s) for n, s in OTHERS.items()}


def pitch_class(note: Column) -> Column:
    """0 (C) to 11; null for what is no note."""
    return F.element_at(_map(pitches()), note)


def _after_root(name: Column) -> Column:
    return F.regexp_extract(name, ROOT, 2)


def root(chord: Column) -> Column:
    """null for what is no chord: another first letter, or a name that ends in a colon, which marks a voice."""
    return F.when(~F.endswith(chord, F.lit(":")), F.nullif(F.regexp_extract(chord, ROOT, 1), F.lit("")))


def quality(chord: Column) -> Column:
    """what follows the root, up to a slash."""
    return F.when(root(chord).isNotNull(), F.substring_index(_after_root(chord), "/", 1))


def bass(chord: Column) -> Column:
    return F.when(root(chord).isNotNull(), F.nullif(F.regexp_extract(_after_root(chord), BASS, 2), F.lit("")))


def interval(a: Column, b: Column) -> Column:
    """semitones from a to b, -5 to 6."""
    n = F.pmod(b - a, F.lit(12))
    return F.when(n > 6, n - 12).otherwise(n)


def uses_flats(key: Column) -> Column:
    """whether the signature of a key named by a chord has flats. A sign in the name says so itself; else the major of that
    pitch decides, or for a minor key the major three semitones up: F, Bb, Eb and Ab have flats."""
    name, rest = F.regexp_extract(key, ROOT, 1), _after_root(key)
    minor = F.startswith(rest, F.lit("m")) & ~F.startswith(rest, F.lit("maj"))
    major = F.pmod(pitch_class(name) + F.when(minor, 3).otherwise(0), F.lit(12))
    return F.when(F.length(name) == 2, F.endswith(name, F.lit("b"))).when(F.length(name) == 1, major.isin([FLATS.index(n) for n in ("F", "Bb", "Eb", "Ab")]))


def note(pitch: Column, flats: Column) -> Column:
    names = lambda n: F.get(F.array(*map(F.lit, n)), F.pmod(pitch, F.lit(12)).cast("int"))
    return F.when(flats, names(FLATS)).otherwise(names(SHARPS))


def transpose(chord: Column, steps: Column, flats: Column) -> Column:
    """root and bass moved and spelled anew, the rest kept. No step leaves a name as it is written; so does what has no root.
    Twelve steps are steps: they spell the name anew."""
    name, rest = F.regexp_extract(chord, ROOT, 1), _after_root(chord)
    low = F.regexp_extract(rest, BASS, 2)
    tail = F.when(low != "", F.concat(F.regexp_extract(rest, BASS, 1), F.lit("/"), note(pitch_class(low) + steps, flats), F.regexp_extract(rest, BASS, 3))).otherwise(rest)
    return F.when((steps == 0) | (name == ""), chord).otherwise(F.concat(note(pitch_class(name) + steps, flats), tail))


def respelled(chord: Column) -> Column:
    """The same chord under the other name of its root; a root without a sign has none."""
    name = F.regexp_extract(chord, ROOT, 1)
    return F.when(F.length(name) == 2, F.concat(note(pitch_class(name), F.endswith(name, F.lit("#"))), _after_root(chord))).otherwise(chord)


def shift_shape(shape: Column, steps: Column) -> Column:
    """a fingering of hexadecimal frets (x: not played) moved the shorter way, else the other way, else null."""
    frets = F.filter(F.split(shape, ""), lambda c: c != "")
    n = F.pmod(steps, F.lit(12))
    n = F.when(n > 6, n - 12).otherwise(n)

    def moved(by: Column) -> Column:
        number = lambda c: F.conv(c, 16, 10).cast("int") + by
        ok = F.forall(frets, lambda c: (c == "x") | number(c).between(0, 15))
        return F.when(ok, F.array_join(F.transform(frets, lambda c: F.when(c == "x", c).otherwise(F.lower(F.hex(number(c).cast("long"))))), ""))

    return F.coalesce(moved(n), moved(F.when(n >= 0, n - 12).otherwise(n + 12)))


def fingering(chord: Column, shape: Column, steps: Column, flats: Column, table: Column) -> Column:
    """the curated fingering (table: map of chord to shape) of the moved chord under either spelling, else the old shape moved."""
    new = transpose(chord, steps, flats)
    return F.coalesce(F.element_at(table, new), F.element_at(table, respelled(new)), shift_shape(shape, steps))


def transpose_fingering_line(line: Column, steps: Column, flats: Column, table: Column) -> Column:
    """a line `**Label:** Em 022000 · G 320003` with every chord moved; a chord without a fingering any more stands alone."""
    label, rest = F.substring_index(line, ":** ", 1), F.regexp_extract(line, r"^.*?:\*\* (.*)$", 1)

    def item(x: Column) -> Column:
        chord, shape = F.substring_index(x, " ", 1), F.nullif(F.regexp_extract(x, r"^\S+ (\S+)$", 1), F.lit(""))
        return F.concat_ws(" ", transpose(chord, steps, flats), fingering(chord, shape, steps, flats, table))

    return F.concat(label, F.lit(":** "), F.array_join(F.transform(F.split(rest, " · "), item), " · "))


def sounded(shape: Column, strings: list[int]) -> Column:
    """the different pitch classes that a fingering sounds on strings of the given pitches."""
    frets = F.filter(F.split(shape, ""), lambda c: c != "")
    tones = F.transform(frets, lambda c, i: F.when(c != "x", F.pmod(F.get(F.array(*map(F.lit, strings)), i) + F.conv(c, 16, 10).cast("int"), F.lit(12))))
    return F.array_sort(F.array_distinct(F.filter(tones, lambda t: t.isNotNull())))


def fits(shape: Column, strings: list[int], expected: Column, optional: Column) -> Column:
    """sounds nothing but the expected classes, and all of them but optional ones."""
    tones = sounded(shape, strings)
    return (F.size(F.array_except(tones, expected)) == 0) & (F.size(F.array_except(F.array_except(expected, tones), optional)) == 0)


def normalise(chords: Column, steps: Column) -> Column:
    """a sequence of chords moved, each written as sharp root and quality, so that sequences compare; what is no chord goes."""
    known = F.filter(chords, lambda c: root(c).isNotNull())
    return F.transform(known, lambda c: F.concat(note(pitch_class(root(c)) + steps, F.lit(False)), quality(c)))


def chord_list(body: Column, grammar: str, between: str | None = None) -> Column:
    """the chords of a body (array of lines) in order: of a line with bracketed ones these, else the tokens of a line of chords alone;
    runs of the same chord become one (W11)."""
    from corpusforge.functions.text import all_tokens, collapse_runs

    def line(x: Column) -> Column:
        inline = F.regexp_extract_all(x, F.lit(r"\[([A-G][b#]?[^\]]*)\]"), 1)
        tokens = F.filter(F.split(x, r"\s+"), lambda t: t != "")
        return F.when(F.size(inline) > 0, inline).when(all_tokens(x, grammar, between), tokens).otherwise(F.array().cast("array<string>"))

    found = F.filter(F.flatten(F.transform(body, line)), lambda c: root(c).isNotNull())
    return let(found, collapse_runs)


def tidy(chord: Column) -> Column:
    """Without the signs around a chord, its root under the sharp name; shorthands of whole chords are written out. The bass stays."""
    bare = F.regexp_replace(F.regexp_replace(chord, r"^[()]+|[()]+$", ""), r"[:.]+$", "")
    low, name = F.regexp_extract(bare, r"^[^/]*(/.*)$", 1), F.substring_index(bare, "/", 1)
    first, rest = F.regexp_extract(name, ROOT, 1), _after_root(name)
    known = F.element_at(_map(SHORTHANDS), name)
    return F.when(first == "", bare).otherwise(F.concat(F.coalesce(known, F.concat(F.coalesce(F.element_at(_map(SHORTHANDS), first), first), rest)), low))


#: Other names of roots and of minor chords, and shorthands of the sources; fixed values.
SHORTHANDS = {
    "Db": "C#", "Eb": "D#", "Gb": "F#", "Ab": "G#", "Bb": "A#", "Dbm": "C#m", "Ebm": "D#m", "Gbm": "F#m", "Abm": "G#m", "Bbm": "A#m",
    "Cb": "B", "Fb": "E", "E#": "F", "B#": "C", "Cm#": "C#m", "Fm#": "F#m", "CaddG": "C",
}
#: X/4 and X7/4, what stands for a suspended fourth; a root with one digit; a diminished or augmented chord. Fixed patterns.
FOURTH, DIGIT, BENT = r"^([A-G]#?)([0-9]*)/4$", r"^([A-G]#?)([0-9])$", r"^([A-G]#?m?)(?:dim|aug|\+)([0-9]*)$"


def _plainer(base: Column) -> Column:
    """What a chord without a bass may be played as: a fifth as the major chord, a fourth as the suspended one, a diminished or augmented one as the diminished
    seventh or the triad, any other plus as augmented or without it."""
    none = F.array().cast("array<string>")
    digit, bent = F.regexp_extract(base, DIGIT, 2), F.regexp_extract(base, BENT, 1)
    short = F.regexp_replace(base, r"\+$", "")
    return (
        F.when(digit == "5", F.array(F.regexp_extract(base, DIGIT, 1))).when(digit == "4", F.array(F.concat(F.regexp_extract(base, DIGIT, 1), F.lit("sus4"))))
        .when(bent != "", F.array(F.concat(bent, F.lit("dim7")), bent)).when(F.endswith(base, F.lit("+")), F.array(F.concat(short, F.lit("aug")), short)).otherwise(none)
    )


def guitar_keys(chord: Column) -> Column:
    """Names to look a chord up under, in order: tidied, X/4 as suspended and nothing else, without its bass, plainer."""
    def keys(t: Column) -> Column:
        fourth = F.regexp_extract(t, FOURTH, 1)
        base = F.substring_index(t, "/", 1)
        return F.when(fourth != "", F.array(t, F.concat(fourth, F.regexp_extract(t, FOURTH, 2), F.lit("sus4")))).otherwise(F.concat(F.array(t, base), _plainer(base)))

    return F.array_distinct(let(tidy(chord), keys))


def ukulele_keys(chord: Column) -> Column:
    """As written, X/4 as suspended and nothing else, without its bass, a fourth as suspended, a diminished chord as its seventh."""
    def keys(t: Column) -> Column:
        none = F.array().cast("array<string>")
        fourth, base = F.regexp_extract(t, FOURTH, 1), F.substring_index(t, "/", 1)
        four = F.regexp_extract(t, r"^([A-G][#b]?(?:m|maj|dim|aug)?)4$", 1)
        more = F.concat(F.array(t, base), F.when(four != "", F.array(F.concat(four, F.lit("sus4")))).otherwise(none), F.when(F.endswith(base, F.lit("dim")), F.array(F.concat(base, F.lit("7")))).otherwise(none))
        return F.when(fourth != "", F.array(t, F.concat(fourth, F.regexp_extract(t, FOURTH, 2), F.lit("sus4")))).otherwise(more)

    return F.array_distinct(let(chord, keys))


def catalogue_keys(chord: Column) -> Column:
    """Tidied, without its bass, plainer; then the same under the flat name of the root."""
    def tried(t: Column) -> Column:
        base = F.substring_index(t, "/", 1)
        return F.concat(F.array(t, base), _plainer(base))

    def keys(t: Column) -> Column:
        first = F.regexp_extract(t, r"^([A-G]#)", 1)
        flat = F.concat(note(pitch_class(first), F.lit(True)), F.substring(t, F.lit(3), F.length(t)))
        return F.when(first != "", F.concat(tried(t), let(flat, tried))).otherwise(tried(t))

    return F.array_distinct(let(tidy(chord), keys))
