"""Record grammars as Column expressions; a failure is a code, never an exception."""

from __future__ import annotations

import unicodedata
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import let

# Parts of the grammars' closed vocabularies.
_SIDES = ["[VR]s\\.", "[Oo]bv\\.", "[Rr]ev\\.", "(?:Seite|side)\\s+[A-Z]", "[a-d]\\."]
_EDGE = "[ourl]\\w*\\.\\s*Rd\\."
_COLUMNS = ["[lrRL][keu]?\\.\\s*(?:Kol|col)\\.?", "(?:Kol\\.\\s*)?\\(?[IVXivx]+\\)?"]
_PRIMES = "′'’″‴´ˈ"
POS = ["ADV", "POSP", "PREV", "CNJ", "NEG", "INTJ", "INDCL", "QUANcar", "QUANmul", "QUANord", "DEMadv", "INTadv", "INDadv"]
CONTROLS = ["①", "②Ⓐ", "ⓐⒸ", "⓶ⓑⒸ", "⓷Ⓐ", "②Ⓑ", "②ⓐⒸ", "②ⓐⒸⓢⓣ", "⓶Ⓒⓐ", "⓶", "⓷", "⓷Ⓑ", "②Ⓒⓐ", "⓶ⓐⒸ", "⓷ⓐⒸ", "②ⓑⒸ", "②ⓐⒸⓐ", "⓶Ⓒⓑ", "ⓢⓣ", "②Ⓒⓑ", "Ⓑ"]
GLUED = ["kinun", "KÙ.BABBAR", "kattan", "maniaḫḫ=eššar", "lukkatta"]
KINDS = ["DEL", "AKK", "HURR", "HAT", "SUM", "LUW"]
MARKS = "()˽_〈〉"


def _part(text: Column, pattern: str, i: int) -> Column:
    return F.regexp_extract(text, pattern, i)


def _either(codes: list[str]) -> str:
    return "(?:" + "|".join(codes) + ")"


def url_path(url: Column) -> Column:
    """scheme, host, lang, number and the first failing part (or ok)."""
    scheme, host = _part(url, "^([a-z]+)://", 1), _part(url, "^[a-z]+://([^/?#]+)", 1)
    lang, number = _part(url, "^[a-z]+://[^/]+/([a-z][a-z])/", 1), _part(url, "/([0-9]+)(\\.html)?/?([?#].*)?$", 1)
    outcome = F.when(scheme == "", "no_scheme").when(lang == "", "no_lang").when(number == "", "no_number").otherwise("ok")
    return F.struct(scheme.alias("scheme"), host.alias("host"), lang.alias("lang"), number.alias("number"), outcome.alias("outcome"))


def source_path(raw: Column) -> Column:
    """cth, project, source_subdir, source_stem, parse_ok, parse_error of a path ``CTH n_XML[_project]/.../stem.xml``.
    The first of eight faults is named; parts that can still be told are given with it."""
    parts = F.split(raw, "/", -1)
    n, name = F.size(parts), F.element_at(parts, -1)
    top = F.get(parts, F.lit(0))
    stem = F.when(F.endswith(name, F.lit(".xml")), F.substring(name, F.lit(1), F.length(name) - 4)).otherwise("")
    below = F.when(n > 2, F.slice(parts, F.lit(2), F.greatest(F.lit(0), n - 2))).otherwise(F.array().cast("array<string>"))
    subdir = F.array_join(below, "/")
    grammar = "^CTH ([0-9]+)_XML(?:_(.+))?$"
    error = (
        F.when(raw.startswith("/"), "absolute_path")
        .when(raw.contains("\\"), "non_posix_separator")
        .when(F.exists(parts, lambda p: p.isin(".", "..")), "path_traversal")
        .when(name == "", "missing_filename")
        .when(n < 2, "missing_top_directory")
        .when(F.exists(below, lambda p: p == ""), "empty_path_component")
        .when(~name.endswith(".xml"), "not_xml")
        .when(stem == "", "missing_filename")
        .when(~top.rlike(grammar), "invalid_top_directory")
        .otherwise("")
    )

    def made(e):
        bare = e.isin("absolute_path", "non_posix_separator")
        return F.struct(
            F.when(e == "", _part(top, grammar, 1)).otherwise("").alias("cth"),
            F.when(e == "", _part(top, grammar, 2)).otherwise("").alias("project"),
            F.when(bare | (e == "path_traversal"), "").otherwise(subdir).alias("source_subdir"),
            F.when(bare, "").otherwise(stem).alias("source_stem"),
            (e == "").alias("parse_ok"),
            e.alias("parse_error"),
        )

    return let(error, made)


def line_reference(ref: Column) -> Column:
    """Parts of a reference such as ``{€1+2} Vs. II 12′``: frag and its sigla, surface, column, ln, prime, tail, and the
    two labels made of them.  What doesn't fit the grammar has empty parts and no number."""
    doubt = "(?:\\(\\?\\)|[!?])?"
    pattern = f"^\\s*(?:\\{{([^}}]*)\\}}\\s*)?((?:{_EDGE}|{_either(_SIDES)}){doubt}\\s*)?({_either(_COLUMNS)}{doubt}\\s*)?(?:([0-9]+)([{_PRIMES}]*)(.*))?\\s*$"
    frag, surface, column, number, prime, tail = (F.trim(_part(ref, pattern, i)) for i in range(1, 7))

    def sigla(f):
        found = F.filter(F.transform(F.split(f, "[+,]"), lambda x: F.trim(x)), lambda x: x != "")
        sign = _part(F.get(found, F.lit(0)), "^[^0-9]", 0)
        return F.transform(found, lambda x: F.when(x.rlike("^[0-9]+$"), F.concat(sign, x)).otherwise(x))

    shown = F.array(*[F.nullif(x, F.lit("")) for x in (frag, surface, column)])
    return F.struct(
        frag.alias("frag"),
        let(frag, sigla).alias("frags"),
        surface.alias("surface"),
        column.alias("column"),
        F.nullif(number, F.lit("")).cast("int").alias("ln"),
        prime.alias("prime"),
        tail.alias("tail"),
        F.array_join(F.array_compact(shown), " ").alias("collabel"),
        F.when(number == "", "").otherwise(F.concat(number.cast("int").cast("string"), prime, tail)).alias("lnno"),
    )


@cache
def _control_like() -> str:
    """A class of all characters that Unicode calls circled, and of parenthesised Latin letters."""
    ranges: list[list[int]] = []
    for c in range(0x2000, 0x20000):
        name = unicodedata.name(chr(c), "")
        if "CIRCLED" in name or name.startswith("PARENTHESIZED LATIN "):
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def control_prefix(field: Column) -> Column:
    """control, rest and whether an unknown control stands first.  A control is one of a closed set, before white
    space or the end, or before a few words where it is glued; anything else of that kind is unknown."""
    glyphs = "[" + "".join(sorted(set("".join(CONTROLS)))) + "]"

    def split(text):
        return let(_part(text, f"^({glyphs}*)", 1), lambda run: let(F.struct(run.alias("run"), F.substring(text, F.length(run) + 1, F.length(text)).alias("after")), lambda x: judged(text, x["run"], x["after"], F.regexp_replace(x["after"], "^\\s+", ""))))

    def judged(text, run, after, rest):
        known = run.isin(*CONTROLS) & ((after == "") | after.rlike("^\\s")) & ~rest.rlike("^" + _control_like())
        taken = known | ((run == "⓷") & after.isin(*GLUED))
        return let(taken, lambda t: F.struct(F.when(t, run).otherwise("").alias("control"), F.when(t, rest).otherwise(text).alias("rest"), (~t & text.rlike("^" + _control_like())).alias("unknown")))

    return let(F.regexp_replace(field, "^\\s+", ""), split)


def field_kind(value: Column) -> Column:
    """kind (empty, pos, stemclass or morph) and pos of a record's fourth field."""

    def told(x):
        t, parts = x["t"], x["parts"]
        every = (F.size(parts) > 0) & F.forall(parts, lambda p: p.isin(*POS))
        kind = F.when(t == "", "empty").when(t.isin(*POS), "pos").when(t.rlike("^(?:[IVX]+|[0-9]+)(?:\\.[0-9]+)*$"), "stemclass").when(every, "pos").otherwise("morph")
        return let(kind, lambda k: F.struct(k.alias("kind"), F.when(k == "pos", F.array_join(parts, " ")).otherwise("").alias("pos")))

    parts = lambda t: F.filter(F.transform(F.split(t, "[,/|]"), lambda p: F.trim(p)), lambda p: p != "")
    return let(let(F.trim(value), lambda t: F.struct(t.alias("t"), parts(t).alias("parts"))), told)


#: Fixed values, the grammar of the records: a lettered alternative, and what parts a record from its clitic.
ALTERNATIVE = "\\{\\s*(\\w+)\\s*→\\s*([^}]*)\\}"
CLITIC_JOINT = "(@?)[ \\t]*(?:\\+=|\\+(?=@))[ \\t]*"


def alternatives(morph: Column) -> Column:
    """Lettered alternatives ``{ a → X}`` as a map; the last of a letter counts."""

    def held(x):
        keys, values = x["keys"], x["values"]
        last = F.filter(F.arrays_zip(keys.alias("k"), values.alias("v"), F.sequence(F.lit(0), F.size(keys)).alias("i")), lambda e: e["k"].isNotNull() & ~F.array_contains(F.slice(keys, e["i"] + 2, F.greatest(F.size(keys), F.lit(1))), e["k"]))
        return F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))

    found = F.struct(F.regexp_extract_all(morph, F.lit(ALTERNATIVE), F.lit(1)).alias("keys"), F.transform(F.regexp_extract_all(morph, F.lit(ALTERNATIVE), F.lit(2)), lambda v: F.trim(v)).alias("values"))
    return let(found, held)


def analysis_record(raw: Column) -> Column:
    """A record ``lemma@gloss@morph@field4@det`` with an optional clitic ``lemma@morph@field4@det`` after ``+=`` or
    ``+@``; fields are trimmed but never dropped.  ok is false, with a note, where the counts of fields or the control
    prefix don't fit; a clitic alone is no failure."""
    cut = lambda x: F.transform(F.split(x, "@", -1), lambda p: F.trim(p))

    def sides(sep):
        found = sep != ""
        at = F.when(found, F.length(F.split(raw, CLITIC_JOINT, 2)[0])).otherwise(F.length(raw))
        return let(at, lambda n: F.struct(sep.alias("sep"), F.substring(raw, F.lit(1), n).alias("base"), F.when(found, F.substring(raw, n + F.length(sep) + 1, F.length(raw))).alias("clitic_text")))

    def fielded(x):
        fields = cut(x["base"])
        return F.struct(fields.alias("fields"), F.when(x["clitic_text"].isNotNull(), cut(x["clitic_text"])).alias("clitic"), x["clitic_text"].alias("clitic_text"), x["base"].alias("base"), x["sep"].alias("sep"))

    def record(x):
        return let(control_prefix(F.get(x["fields"], F.lit(0))), lambda control: judged(x, control))

    def judged(x, control):
        fields, clitic = x["fields"], x["clitic"]
        n = F.size(fields)
        alone = clitic.isNotNull() & ((F.trim(x["base"]) == "") | ((control["control"] != "") & (control["rest"] == "") & F.forall(F.slice(fields, 2, F.greatest(n, F.lit(1))), lambda f: f == "")))
        return let(alone, lambda y: let(F.when(~y & (n >= 3), F.coalesce(F.get(fields, F.lit(3)), F.lit(""))).otherwise(""), lambda value: let(field_kind(value), lambda kind: made(x, control, y, kind))))

    def made(x, control, alone, kind):
        fields, clitic = x["fields"], x["clitic"]
        n, m = F.size(fields), F.size(clitic)
        lemma = F.when(control["unknown"], "").otherwise(control["rest"])
        get = lambda a, i: F.coalesce(F.get(a, F.lit(i)), F.lit(""))
        short = n < 3
        long_ = F.when(clitic.isNull(), n > 5).otherwise(F.lit(False))
        notes = F.array_compact(
            F.array(
                F.when(control["unknown"], "unknown analysis-control prefix"),
                F.when(alone, "clitic-only").when(short, F.concat(F.lit("base has "), n.cast("string"), F.lit(" field(s)"))).when(long_, F.concat(F.lit("base has "), n.cast("string"), F.lit(" fields"))),
                F.when(~alone & ~short & (m > 4), F.concat(F.lit("clitic has "), m.cast("string"), F.lit(" fields"))),
            )
        )
        whole = ~alone & ~short
        has = clitic.isNotNull() & (alone | whole)
        inner = F.struct(get(clitic, 0).alias("lemma"), get(clitic, 1).alias("morph"), get(clitic, 2).alias("stemclass"), get(clitic, 3).alias("det"), alternatives(get(clitic, 1)).alias("alts"))
        return F.struct(
            F.when(alone, "").otherwise(lemma).alias("lemma"),
            F.when(alone, "").otherwise(get(fields, 1)).alias("gloss"),
            F.when(whole, get(fields, 2)).otherwise("").alias("morph"),
            F.when(whole, get(fields, 3)).otherwise("").alias("stemclass"),
            F.when(whole & clitic.isNull(), get(fields, 4)).otherwise("").alias("det"),
            alternatives(F.when(whole, get(fields, 2)).otherwise("")).alias("alts"),
            F.when(has, inner).alias("clitic"),
            F.when(alone, "empty").when(short, "").otherwise(kind["kind"]).alias("field4_kind"),
            kind["pos"].alias("pos"),
            control["control"].alias("control"),
            x["sep"].alias("sep"),
            (~control["unknown"] & (alone | ~(short | long_ | F.coalesce(m > 4, F.lit(False))))).alias("ok"),
            F.array_join(notes, "; ").alias("note"),
            ((F.array_join(fields, "@") != x["base"]) | (control["control"] != "") | F.coalesce(F.array_join(clitic, "@") != x["clitic_text"], F.lit(False))).alias("normalised"),
        )

    return let(let(let(_part(raw, CLITIC_JOINT, 0), sides), fielded), record)


def numbered(attributes: Column, stem: str = "mrp") -> Column:
    """(index, value) of a map's entries ``stem`` + number, in the order of the numbers; gaps stay."""
    mine = F.filter(F.map_entries(attributes), lambda e: e["key"].rlike(f"^{stem}[0-9]+$"))
    return F.array_sort(F.transform(mine, lambda e: F.struct(F.substring(e["key"], len(stem) + 1, 9).cast("int").alias("index"), e["value"].alias("value"))))


def attributes(blob: Column) -> Column:
    """The attributes of a start tag, quoted either way, as a map; the first of a name counts."""
    pair = "([^\\s=\"'<>/]+)\\s*=\\s*(\"[^\"]*\"|'[^']*')"
    names, values = (F.regexp_extract_all(blob, F.lit(pair), F.lit(i)) for i in (1, 2))
    rows = F.arrays_zip(names.alias("k"), values.alias("v"), F.sequence(F.lit(1), F.greatest(F.size(names), F.lit(1))).alias("i"))
    first = F.filter(rows, lambda x: x["k"].isNotNull() & (F.array_position(names, x["k"]) == x["i"]))
    return F.map_from_entries(F.transform(first, lambda x: F.struct(x["k"], F.substring(x["v"], F.lit(2), F.length(x["v"]) - 2))))


def selectors(raw: Column) -> Column:
    """Selection tokens such as ``1 2a 3bR 0sg``: index, lower-case letters of the base's alternative, upper-case ones of
    the clitic's, and a group (all, sg or pl) that stands alone or ends the letters."""
    tokens = F.filter(F.split(F.trim(raw), "\\s+"), lambda t: t.rlike("^[0-9]+[A-Za-z]*$"))

    def one(t):
        letters = _part(t, "^[0-9]+([A-Za-z]*)$", 1)
        low, high = F.regexp_replace(letters, "[A-Z]", ""), F.regexp_replace(letters, "[a-z]", "")
        group = F.when(letters.isin("all", "sg", "pl"), letters).otherwise(_part(low, "(sg|pl)$", 1))
        base = F.when(letters == "all", "").otherwise(F.regexp_replace(low, "(?:sg|pl)$", ""))
        return F.struct(_part(t, "^[0-9]+", 0).cast("int").alias("index"), base.alias("base_alt"), high.alias("clitic_alt"), group.alias("group"), t.alias("raw"))

    return F.transform(tokens, one)


def selection_kind(raw: Column) -> Column:
    """none (nothing given), a language or deletion mark, unknown, or analysis; the last mark counts."""
    tokens = F.filter(F.split(F.trim(F.coalesce(raw, F.lit(""))), "\\s+"), lambda t: t != "")
    marks = F.filter(tokens, lambda t: t.isin(*KINDS, "???"))
    last = F.element_at(marks, -1)
    return F.when(F.size(tokens) == 0, "none").when(F.size(marks) > 0, F.when(last == "???", "unknown").otherwise(last)).when(F.exists(tokens, lambda t: t.rlike("^[0-9]+[A-Za-z]*$")), "analysis").otherwise("unknown")


def selector_class(raw: Column) -> Column:
    """empty, numeric, special, unknown, or two of the last three joined by a plus."""
    tokens = F.filter(F.split(F.trim(F.coalesce(raw, F.lit(""))), "\\s+"), lambda t: t != "")
    has = lambda test: F.exists(tokens, test)
    number, special, doubt = has(lambda t: t.rlike("^[0-9]+[A-Za-z]*$")), has(lambda t: t.isin(*KINDS)), has(lambda t: t == "???")
    other = F.when(special, "special").when(doubt, "unknown")
    return F.when(F.size(tokens) == 0, "empty").when(number & other.isNotNull(), F.concat(other, F.lit("+numeric"))).when(number, "numeric").otherwise(F.coalesce(other, F.lit("other")))


def numeral(n: Column) -> Column:
    """Sign-value notation of 1 to 39: a sign for each ten, then one for each unit."""
    return F.when(n.between(1, 39), F.concat(F.repeat(F.lit("𒌋"), F.floor(n / 10).cast("int")), F.repeat(F.lit("𒁹"), (n % 10).cast("int"))))


def codepoints(text: Column) -> Column:
    """Signs of an aligned line: an unrendered sign is one; white space, annotation and combining marks drop out."""
    cleaned = F.regexp_replace(F.replace(text, F.lit("?°?"), F.lit("�")), "[\\s?|°\\p{Mn}]", "")
    return F.filter(F.split(cleaned, ""), lambda c: c != "")


def is_script(text: Column) -> Column:
    """Whether all code points are signs of the script, placeholders or private use."""
    return F.coalesce(text.rlike("^[\\x{12000}-\\x{1254F}▒\\x{F0000}-\\x{10FFFD}]+$"), F.lit(False))


def private_use(text: Column, mapped: Column | None = None) -> Column:
    """total: private-use code points of the three ranges; unmapped: those that ``mapped`` doesn't hold."""
    found = F.filter(F.split(text, ""), lambda c: c.rlike("^[\\x{E000}-\\x{F8FF}\\x{F0000}-\\x{FFFFD}\\x{100000}-\\x{10FFFD}]$"))
    known = mapped if mapped is not None else F.array().cast("array<string>")
    return F.struct(F.size(found).alias("total"), F.size(F.filter(found, lambda c: ~F.array_contains(known, c))).alias("unmapped"))


def lookup_id(raw: Column) -> Column:
    """The identifier without one plus at its end; null where an indirect or double join ends it, or nothing is left."""
    text = F.trim(raw)
    return F.when(text.endswith("(+)") | text.endswith("++"), None).otherwise(F.nullif(F.trim(F.regexp_replace(text, "\\+$", "")), F.lit("")))


def identifier_flags(raw: Column) -> Column:
    """Names of what makes an identifier hard to look up."""
    tests = {"empty": F.trim(raw) == "", "padded": raw != F.trim(raw), "inner_space": F.trim(raw).rlike("\\s\\s"), "plus": raw.contains("+"), "bracket": raw.rlike("[()\\[\\]]"), "not_ascii": raw.rlike("[^\\x00-\\x7F]"), "slash": raw.contains("/")}
    return F.array_compact(F.array(*[F.when(t, n) for n, t in tests.items()]))


def web_link(base: str, key: Column) -> Column:
    """The address of a record, percent-encoded; null without a key."""
    return F.concat(F.lit(base + "?d="), F.replace(F.url_encode(key), F.lit("+"), F.lit("%20")))


def html_safe(text: Column) -> Column:
    for plain, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def class_list(flags: dict[str, Column]) -> Column:
    """The names whose flag is set, space-joined."""
    return F.concat_ws(" ", *[F.when(c, n) for n, c in flags.items()])


def blob_sha1(content: Column) -> Column:
    """The hash that a version store gives a file: of its kind, length, a zero byte and the content."""
    data = F.encode(content, "utf-8")
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(data).cast("string")), "utf-8"), F.unhex(F.lit("00")), data))


def siglum(raw: Column) -> Column:
    """White space collapsed, and a euro sign joined to its number."""
    return F.regexp_replace(F.trim(F.regexp_replace(raw, "\\s+", " ")), "€ (?=[0-9])", "€")


def reading_key(raw: Column) -> Column:
    """A reading in one spelling: digraphs written out become letters, plain h the one with a breve, digits subscripts."""
    out = F.lower(raw)
    for digraph, letter in (("sz", "š"), ("s,", "ṣ"), ("t,", "ṭ"), ("h", "ḫ")):
        out = F.replace(out, F.lit(digraph), F.lit(letter))
    return F.translate(out, "0123456789", "₀₁₂₃₄₅₆₇₈₉")


#: What a faulty replacement made of the letters of captions, and what they were.
CAPTION_DAMAGE = (("%", "x"), ("ḫ", "h"), ("p", "b"), ("k", "g"))


def undamaged(caption: Column) -> Column:
    """A caption that a faulty replacement hit, put right: each letter that it wrote goes back to the one it stood for."""
    for bad, good in CAPTION_DAMAGE:
        caption = F.replace(caption, F.lit(bad), F.lit(good))
    return caption


def undamaged_text(caption: str) -> str:
    """As ``undamaged``, of one caption."""
    return reduce(lambda text, pair: text.replace(*pair), CAPTION_DAMAGE, caption)


def join_marks(raw: Column) -> Column:
    """Join marks in order: direct +, indirect (+), double ++ and doubtful (+)?, each only between neighbours that may join."""
    found = F.regexp_extract_all(raw, F.lit("(?<![+(\\w])(?:\\(\\+\\)\\??|\\+\\+?)(?![+)\\w])"), F.lit(0))
    return F.transform(found, lambda m: F.when(m == "+", "direct").when(m == "(+)", "indirect").when(m == "++", "double").otherwise("doubtful"))


def strip_marks(sym: Column, marks: str = MARKS) -> Column:
    """reading without editorial marks, and the marks in order."""
    inside = "".join("\\" + c if c in "()[]" else c for c in marks)
    return F.struct(F.translate(sym, marks, "").alias("reading"), F.regexp_replace(sym, f"[^{inside}]", "").alias("symmark"))
