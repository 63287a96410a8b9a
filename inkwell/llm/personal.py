"""Personal information in free text: found by bootstrapped contextual extraction, replaced by typed placeholders.

1. Shapes. Strong shapes show their type themselves (an e-mail address, a telephone number with a country code, a street with
   a house number). Weak shapes (two capitalised words, a run of digits) are mere candidates.
2. Bootstrapping. Candidates before an e-mail address seed the given names; numbers with a country code and numbers behind a
   seed keyword seed the number types. All documents are searched for candidates with their left and right contexts; Spark sums
   the pattern-instance graph and scores it in rounds: a pattern is trusted if nearly all it surrounds is trusted, an instance
   if most of its uses lie in trusted patterns. The instances are given names for persons and shapes (digits as 0) for numbers,
   so a context no seed ever stood in is learned from the shapes it shares with trusted ones.
3. Extraction. A candidate is a mention if its instance or a context is trusted; so unseen names are found in known contexts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.session import checkpoint

TYPES = ("email", "phone", "identity_number", "street_address", "person_name")
ROUNDS = 3
TRUST = 0.75  # the share of trusted instances that makes a pattern trusted
SUPPORT = 1e-6  # of all uses: what is learned must be used so often (and 3 times), so no list has more than 1 / SUPPORT entries
SHAPED = {True: 0.4, False: 0.8}  # the share of a number shape's uses that must be of one type before the shape speaks for it: with letters, digits only

# Words that begin or mark a shape.
TITLES = r"Mrs|Mr|Ms|Dr|Prof|Frau|Herr|Mme|Mlle|M|Sra|Sr|Srta|Doña|Don"
STREETS = r"Street|Str|St|Road|Rd|Lane|Ln|Avenue|Ave|Close|Terrace|Drive|Dr|Way|Court|Crescent|Place|Square|Gardens|Row|Walk|Hill"
IDENTITY_SEEDS = r"SSN|NI|ID|DNI|NIE|NIF|CNI|passport|Passport|security number|insurance number|licence|license|Reisepass|Personalausweis|Ausweis|Steuer|passeport|sécurité|identité|identidad|pasaporte|护照|身份证|证件"
PHONE_SEEDS = r"[Tt]el|TEL|[Tt]él|[Pp]hone|[Mm]obile|[Ff]ax|[Tt]elefon\w*|[Tt]éléphone|[Tt]eléfono|Handy|电话|手机"

_UP, _LOW = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
EMAIL = re.compile(r"(?:mailto:)?[\w.+-]+(?:\s?@\s?|\s?\(at\)\s?|\s?\[at\]\s?)[\w-]+(?:\s?(?:\.|\[dot\]|\(dot\))\s?[\w-]+)*?\s?(?:\.|\[dot\]|\(dot\))\s?[A-Za-z]{2,}(?:(?:\.|\s?\[dot\]\s?|\s?\(dot\)\s?)[A-Za-z]{2,})*(?![\w-])", re.A | re.I)
NAME = re.compile(
    rf"(?<![\w@.+/-])(?:(?:{TITLES})\.?\s)?(?:"
    rf"(?P<given>[{_UP}][{_LOW}]+)\s(?:[{_UP}]\.\s)?(?P<last>[{_UP}][{_LOW}]+)(?:-[{_UP}][{_LOW}]+)?"
    rf"|[{_UP}]{{3,}}(?:-[{_UP}]{{3,}})?,\s(?P<given2>[{_UP}][{_LOW}]+))(?![\w@])"
)
NUMBER = re.compile(r"(?<![A-Za-z0-9_.,/+-])(?!(?:SSN|NI|ID|DNI|NIE|NIF|CNI) )(?:[(（]?\+\d|[(（]\d{2,}|[A-Z]{1,3} ?\d|\d)(?:[ ./()（）-]{0,3}[A-Z]?\d){6,20}(?:-?[A-Z]{1,2}\b\d*)?(?!\w*[\d@])(?![.,]\d)")
#: Words one of which a text must hold, and the shape.
ADDRESSES = [
    (STREETS.split("|"), re.compile(rf"(?<![\w.,])(?:(?:Flat|Apt|Unit)\.?\s\d+[A-Z]?,\s)?\d{{1,4}}[A-Z]?,?\s(?:[{_UP}][{_LOW}]+\s){{1,2}}(?:{STREETS})\b")),
    (("Box", "Postfach", "BP", "B.P", "postale", "Apartado", "Apdo"), re.compile(r"\bP\.?\s?O\.?\s+Box\s+\d+|\b(?:Postfach|BP|B\.P\.|Boîte postale|Apartado(?:\s+de\s+[Cc]orreos)?|Apdo\.?)\s+\d[\d ]*")),
    (("straße", "strasse", "str.", "weg ", "gasse ", "platz ", "allee ", "ring ", "damm ", "Am ", "An der ", "Im ", "Zum ", "Zur "), re.compile(rf"\b[{_UP}][{_LOW}]+(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|damm)\s\d{{1,3}}\s?[a-z]?\b|\b(?:Am|An der|Im|Zum|Zur)\s[{_UP}][{_LOW}]+\s(?:[{_UP}][{_LOW}]+\s)?\d{{1,3}}[a-z]?(?=,)")),
    (("rue", "avenue", "boulevard", "place", "chemin", "allée", "impasse", "quai", "route", "cours"), re.compile(r"(?<![\w.,])\d{1,4}(?:\s(?:bis|ter|quater))?,?\s(?:rue|avenue|boulevard|place|chemin|allée|impasse|quai|route|cours)\s(?:de\s|du\s|des\s|d’|la\s)*\w+")),
    (("Calle", "Avda", "Avenida", "Plaza", "Pza", "Paseo", "Camino", "Ronda", "C/"), re.compile(r"(?:\b(?:Calle|Avda\.?|Avenida|Plaza|Pza\.?|Paseo|Camino|Ronda)|\bC/)\s(?:de\s|del\s|la\s)*[\w’-]+,?\s(?:n\.º\s|núm\.\s)?\d+")),
    (("路", "街", "大道", "巷", "胡同", "弄", "信箱"), re.compile(r"(?:[一-鿿]{2,3}[省市县区乡镇])?[一-鿿]{1,3}(?:路|街|大道|巷|胡同|弄)\d+号(?:附\d+号)?(?:\d+单元)?(?:\d+室)?|(?:邮政)?信箱\d+号?")),
]
_AT = re.compile(r"@|[(\[]at[)\]]", re.I)
#: All that may follow the at sign in EMAIL.
_HOST = re.compile(r"\s?[\w-]+(?:\s?(?:\.|\[dot\]|\(dot\))\s?[\w-]+)*", re.A | re.I)
_HAN_MAIL = re.compile(r"(?<![一-鿿])([一-鿿]{2,4})(?:[,;，；]\s?|\s/\s|\s?[（(])(?:mailto:|<)?[\w.+-]+(?:\s?@|\s?\(at\)|\s?\[at\])", re.A)
_BEFORE_MAIL = re.compile(r"(?:[,;]\s|\s/\s|\s\()(?:mailto:|<)?[\w.+-]+(?:\s?@|\s?\(at\)|\s?\[at\])", re.A)
_SEED = re.compile(rf"(?<![A-Za-z])(?:{IDENTITY_SEEDS})(?![A-Za-z]*@)[^\d\n@]{{0,12}}$")

_PHONE_SEED = re.compile(rf"(?<![A-Za-z])(?:{PHONE_SEEDS})(?![A-Za-z]*@)[.:：\s]{{0,4}}$")


def left_key(text: str, at: int) -> str:
    """The two words before a candidate (for Chinese the three characters), in lower case, digits as 0. A context doesn't reach
    over a line's or sentence's end, and a word with a colon stands alone; "L" says nothing."""
    part = text[max(0, at - 40) : at]
    part = part[part.rfind("\n") + 1 :]
    bare = part.rstrip("：: ")
    if bare and "一" <= bare[-1] <= "鿿":
        return "L" + bare[-3:]
    words = part.split()[-2:]
    if not words or "@" in words[-1] or "]" in words[-1]:
        return "L"
    if len(words) == 2 and (words[0][-1] in ".!?;,)。0123456789" or words[-1][-1] == ":" and len(words[-1]) > 1):
        words = words[1:]
    return "L" + " ".join(re.sub(r"\d+", "0", w).lower() for w in words)


def right_key(text: str, at: int) -> str:
    """The two words after a candidate, likewise; R@ before an e-mail address; "R" says nothing."""
    if _BEFORE_MAIL.match(text, at):
        return "R@"
    part = text[at : at + 40].split("\n", 1)[0]
    if part and "一" <= part[0] <= "鿿":
        return "R" + part[:3]
    words = part.split()[:2]
    if not words or part[0] in ".!?;。" or words[0][0].isupper() or not part[0].isspace() and part[0] not in ",)）":
        return "R"
    return "R" + (" " if part[0].isspace() else "") + " ".join(re.sub(r"\d+", "0", w).lower() for w in words)


def number_kind(s: str, text: str, start: int) -> str:
    """phone+, identity+ for strong shapes and seeds; phone?, identity? for weak ones; other."""
    digits = sum(c.isdigit() for c in s)
    if _SEED.search(text, max(0, start - 30), start):
        return "identity+"
    if (s.lstrip("(（").startswith("+") or s.startswith("00") and s[4:5] in "- ") and 9 <= digits <= 15:
        return "phone+"
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", s):
        return "identity+"
    if re.search(r"[A-Z]", s) or digits > 15 or re.fullmatch(r"\d{6}-\d{4}", s):
        return "identity?"
    if not 8 <= digits <= 13:
        return "other"
    return "phone+" if _PHONE_SEED.search(text, max(0, start - 16), start) else "phone?"


def names_in(text: str) -> Iterator[re.Match]:
    """All candidates for names, also those that begin with another's last word."""
    m = NAME.search(text)
    while m:
        yield m
        m = NAME.search(text, m.start("last") if m["last"] else m.end())


def candidates(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(kind, instance, start, end) of the weak and strong candidates for the graph."""
    for m in names_in(text):
        yield "name", m["given"] or m["given2"], m.start(), m.end()
    for m in NUMBER.finditer(text):
        kind = number_kind(m[0], text, m.start())
        yield "number", kind if kind == "other" else f"{kind}|{shape_of(m[0])}", m.start(), m.end()


def shape_of(number: str) -> str:
    return re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", number))


def graph(docs: DataFrame, text: str) -> DataFrame:
    """(kind, instance, pattern, n): how often each candidate's instance stood in each context, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for kind, instance, start, end in candidates(t):
                    left, right = left_key(t, start), right_key(t, end)
                    if kind == "name" and left[-1] in ".!?…”。)0":
                        left = "L"  # a sentence's or number's end before a name says nothing
                    edges[kind, instance, left] += 1
                    edges[kind, instance, right] += 1
                if "一" <= max(t, default="") and ("@" in t or "at" in t):
                    for m in _HAN_MAIL.finditer(t):
                        edges["han", m[1][0] if len(m[1]) < 4 else m[1][:2], "R@"] += 1
            if len(edges) > 300_000:
                yield _as_batch(edges)
                edges = Counter()
        yield _as_batch(edges)

    out = docs.where(F.col(text).isNotNull()).select(text).mapInArrow(run, "kind string, instance string, pattern string, n long")
    return out.groupBy("kind", "instance", "pattern").agg(F.sum("n").alias("n"))


def _as_batch(edges: Counter) -> pa.RecordBatch:
    keys = list(edges)
    return pa.RecordBatch.from_arrays([pa.array([k[i] for k in keys], pa.string()) for i in range(3)] + [pa.array(list(edges.values()), pa.int64())], ["kind", "instance", "pattern", "n"])


def han_graph(docs: DataFrame, text: str, surnames: list[str]) -> DataFrame:
    """Contexts of Chinese candidates: a seeded surname and one or two characters, and how often each context occurs at all."""
    if not surnames:
        return docs.sparkSession.createDataFrame([], "pattern string, n long")
    name = re.compile(rf"(?:{'|'.join(map(re.escape, sorted(surnames, key=len, reverse=True)))})[一-鿿]{{2}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for m in name.finditer(t):
                    for k in (left_key(t, m.start()), right_key(t, m.end())):
                        if len(k) == 4 and "一" <= k[1] and k[2:] and "一" <= k[3]:
                            edges["", "", k] += 1
        yield _as_batch(edges)

    hits = docs.where(F.col(text).rlike("|".join(surnames))).select(text)
    return hits.mapInArrow(run, "kind string, instance string, pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def han_totals(docs: DataFrame, text: str, patterns: list[str]) -> DataFrame:
    if not patterns:
        return docs.sparkSession.createDataFrame([], "pattern string, total long")
    any_of = re.compile("|".join(sorted({re.escape(p[1:]) for p in patterns})))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for m in any_of.finditer(t):
                    edges["", "", m[0]] += 1
        yield _as_batch(edges)

    hits = docs.where(F.col(text).rlike("[一-鿿]")).select(text)
    return hits.mapInArrow(run, "kind string, instance string, pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("total"))


@dataclass
class Trusted:
    """What bootstrapping learned: bounded lists that go to every worker."""

    given: set[str] = field(default_factory=set)
    name_patterns: set[str] = field(default_factory=set)
    phone_patterns: set[str] = field(default_factory=set)
    identity_patterns: set[str] = field(default_factory=set)
    han_patterns: set[str] = field(default_factory=set)
    surnames: set[str] = field(default_factory=set)


def _spread(edges: DataFrame, seeds: DataFrame, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """Trusted instances and patterns of the weighted graph ``edges`` (instance, pattern, n) after some rounds."""
    trusted = seeds
    patterns = None
    for _ in range(ROUNDS):
        known = edges.join(trusted.withColumn("ok", F.lit(1)), "instance", "left")
        by_pattern = known.groupBy("pattern").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("ok") == 1, F.col("n")).otherwise(0)).alias("good"), F.count_distinct(F.when(F.col("ok") == 1, F.col("instance"))).alias("kinds"))
        patterns = by_pattern.where((F.col("good") >= least) & (F.col("kinds") >= 2) & (F.col("good") >= TRUST * F.col("all")) & (F.length("pattern") > 1)).select("pattern", "good")
        # each use has a left and a right context; those that say nothing don't count
        scored = edges.where("length(pattern) > 1").join(patterns.select("pattern", F.lit(1).alias("ok")), "pattern", "left").groupBy("instance").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("ok") == 1, F.col("n")).otherwise(0)).alias("good"))
        more = scored.where((F.col("good") >= least) & (F.col("good") >= 0.4 * F.col("all"))).select("instance")
        trusted = checkpoint(seeds.unionByName(more).distinct())
    return trusted, patterns


def _spread_numbers(edges: DataFrame) -> dict[str, DataFrame]:
    """Trusted patterns of phone and identity numbers after some rounds between contexts and shapes. edges: kind, shape, pattern, n.

    Strong kinds are the seeds. A context needs some seeds, or half its uses in trusted shapes, and nearly all of a likely kind; a
    shape needs nearly all its uses in trusted contexts or as seeds."""
    likely = {"phone": ("phone+", "phone?"), "identity": ("identity+", "identity?", "phone?")}
    least_share = {"phone": 0.02, "identity": 0.3}
    shapes: dict[str, DataFrame | None] = {"phone": None, "identity": None}
    patterns: dict[str, DataFrame] = {}
    said = edges.where("length(pattern) > 1 and pattern <> 'R@'")
    for turn in range(ROUNDS):
        for what, kinds in likely.items():
            strong = F.col("kind") == what + "+"
            known = said.join(shapes[what].withColumn("ok", F.lit(True)), "shape", "left") if shapes[what] is not None else said.withColumn("ok", F.lit(False))
            sums = known.groupBy("pattern").agg(
                F.sum("n").alias("good"), F.sum(F.when(strong, F.col("n")).otherwise(0)).alias("seeds"), F.sum(F.when(F.col("kind").isin(*kinds), F.col("n")).otherwise(0)).alias("likely"),
                F.sum(F.when(strong | F.coalesce("ok", F.lit(False)) & F.col("kind").isin(*kinds), F.col("n")).otherwise(0)).alias("mass"))
            enough = (F.col("seeds") >= 2) & (F.col("seeds") >= least_share[what] * F.col("good")) | (F.col("mass") >= 3) & (F.col("mass") >= 0.5 * F.col("good"))
            side = F.lit(True) if what == "identity" else F.col("pattern").startswith("L")
            patterns[what] = sums.where(enough & side & (F.col("likely") >= TRUST * F.col("good"))).select("pattern", "good")
        for what in likely if turn + 1 < ROUNDS else ():
            strong = F.col("kind") == what + "+"
            # each use has a left and a right context; those that say nothing count only as seeds
            uses = edges.where("pattern like 'L%' and shape <> ''").join(patterns[what].select("pattern", F.lit(True).alias("in")), "pattern", "left")
            per = uses.groupBy("shape").agg(F.sum("n").alias("all"), F.sum(F.when(strong | F.col("in"), F.col("n")).otherwise(0)).alias("good"))
            shapes[what] = checkpoint(per.where((F.col("good") >= 3) & (F.col("good") >= F.when(F.col("shape").contains("A"), SHAPED[True]).otherwise(SHAPED[False]) * F.col("all"))).select("shape"))
    return patterns


def learn(docs: DataFrame, text: str = "text") -> Trusted:
    edges = checkpoint(graph(docs, text))
    floor = SUPPORT * (edges.agg(F.sum("n")).first()[0] or 0)

    names = edges.where("kind = 'name'").select("instance", "pattern", "n")
    total = names.groupBy("instance").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("pattern") == "R@", F.col("n")).otherwise(0)).alias("mail"))
    seeds = total.where("mail >= 2 and mail >= 0.1 * all").select("instance")
    given, patterns = _spread(names, seeds)
    given = given.join(total.select("instance", F.col("all").alias("good")), "instance")
    held = lambda df, c: {r[0] for r in df.where(F.col("good") >= floor).select(c).collect()}

    part = lambda k: F.coalesce(F.get(F.split("instance", r"\|", 2), F.lit(k)), F.lit(""))
    numbers = _spread_numbers(checkpoint(edges.where("kind = 'number'").select(part(0).alias("kind"), part(1).alias("shape"), "pattern", "n")))
    trusted = {k: held(v, "pattern") for k, v in numbers.items()}

    surnames = sorted(r[0] for r in edges.where("kind = 'han' and pattern = 'R@'").where(F.col("n") >= max(2.0, floor)).select("instance").distinct().collect())
    han = checkpoint(han_graph(docs, text, surnames))
    often = sorted(r[0] for r in han.where(F.col("n") >= max(3.0, floor)).select("pattern").collect())
    seen = han_totals(docs, text, often)
    share_han = han.withColumn("chars", F.substring("pattern", 2, 10)).join(seen.withColumnRenamed("pattern", "chars"), "chars")
    good_han = {r[0] for r in share_han.where(F.col("n") >= max(3.0, floor)).where(f"n >= {TRUST} * total").select("pattern").collect()}
    return Trusted(held(given, "instance"), held(patterns, "pattern"), trusted["phone"], trusted["identity"], good_han, set(surnames))


def _context(pattern: str) -> str:
    """The expression of a learned context: its words, with any white space between, digits standing for any."""
    return r"\s+".join(re.escape(w).replace("0", r"\d+") for w in pattern[1:].split())


class Finder:
    """Finds the mentions of one text: (start, end, type), in order, not overlapping. Everything learned is compiled into a
    few expressions, so the work a text costs doesn't depend on how many words in it have a capital."""

    def __init__(self, t: Trusted):
        import regex

        self.t = t
        self.han_right = tuple(sorted({p[1:] for p in t.han_patterns if p[0] == "R"}))
        han_left = sorted({re.escape(p[1:]) for p in t.han_patterns if p[0] == "L"})
        sur = "|".join(map(re.escape, sorted(t.surnames, key=len, reverse=True)))
        self.surname = re.compile(rf"(?:{sur})[一-鿿]{{2}}" if sur else "(?!)")
        self.han_after = re.compile(rf"(?:{'|'.join(han_left)})[：:]?([一-鿿]{{3}})" if han_left else "(?!)")

        title, last = rf"(?:(?:{TITLES})\.?\s)?", rf"[{_UP}][{_LOW}]+(?:-[{_UP}][{_LOW}]+)?"
        turned = rf"[{_UP}]{{3,}}(?:-[{_UP}]{{3,}})?,\s"
        shape = rf"{title}(?:[{_UP}][{_LOW}]+\s(?:[{_UP}]\.\s)?{last}|{turned}[{_UP}][{_LOW}]+|[{_UP}][{_LOW}]{{2,}}(?:-[{_UP}][{_LOW}]+)?)(?![\w@-])"
        self.known = regex.compile(rf"(?<![\w@.+/-]){title}(?:\L<given>\s(?:[{_UP}]\.\s)?{last}|{turned}\L<given>)(?![\w@])", given=sorted(t.given) or ["\0"])
        lefts = [_context(p) for p in sorted(t.name_patterns) if p[0] == "L" and len(p) > 1]
        rights = [(r"\s+" if p[1] == " " else "") + _context(p) for p in sorted(t.name_patterns) if p[0] == "R" and len(p) > 1 and p != "R@"]
        # the contexts up to their first digit, to pass over texts without any
        self.left_words = sorted({p[1:].split("0")[0].strip() for p in t.name_patterns if p[0] == "L" and len(p) > 1})
        self.right_words = sorted({p[1:].split("0")[0].strip() for p in t.name_patterns if p[0] == "R" and len(p) > 1 and p != "R@"})
        mail = [_BEFORE_MAIL.pattern] if "R@" in t.name_patterns else []
        self.after_context = re.compile(rf"(?:(?i:{'|'.join(lefts)}))\s+({shape})" if lefts else "(?!)")
        self.before_context = re.compile(rf"(?<![\w@.+/-])({shape})(?=(?i:{'|'.join(rights + mail)}))" if rights or mail else "(?!)")

    @staticmethod
    def mails(text: str) -> list[tuple[int, int]]:
        """Addresses, searched for only in the lines with an at sign and those over which its address may go on."""
        stretches: list[list[int]] = []
        for m in _AT.finditer(text):
            at, host = m.start(), _HOST.match(text, m.end())
            begin = text.rfind("\n", 0, at - 1 if text[at - 1 : at] == "\n" else at) + 1
            end = text.find("\n", host.end() if host else m.end())
            end = end if end >= 0 else len(text)
            if stretches and begin <= stretches[-1][1]:
                stretches[-1] = [min(begin, stretches[-1][0]), max(end, stretches[-1][1])]
            else:
                stretches.append([begin, end])
        return [x.span() for a, b in stretches for x in EMAIL.finditer(text, a, b)]

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        t, found = self.t, []
        mails: list[tuple[int, int]] = []
        if "@" in text or "at)" in text or "at]" in text or "AT)" in text or "AT]" in text:
            mails = self.mails(text)
            found += [(a, b, "email") for a, b in mails]
        for words, shape in ADDRESSES:
            if any(w in text for w in words):
                found += [(*m.span(), "street_address") for m in shape.finditer(text)]
        for m in NUMBER.finditer(text):
            s, (a, b) = m[0], m.span()
            kind = number_kind(s, text, a)
            if kind == "phone+":
                found.append((a, b, "phone"))
            elif kind == "identity+":
                found.append((a, b, "identity_number"))
            elif kind != "other":
                left = left_key(text, a)
                if left in t.identity_patterns or kind == "identity?" and right_key(text, b) in t.identity_patterns:
                    found.append((a, b, "identity_number"))
                elif kind == "phone?" and (left in t.phone_patterns or any(0 <= a - e <= 4 for _, e in mails)):
                    found.append((a, b, "phone"))
        found += [(*m.span(), "person_name") for m in self.known.finditer(text)]
        low = " ".join(text.lower().split())
        if any(w in low for w in self.left_words):
            found += [(*m.span(1), "person_name") for m in self.after_context.finditer(text)]
        if mails or any(w in low for w in self.right_words):
            found += [(*m.span(1), "person_name") for m in self.before_context.finditer(text)]
        if "。" in text or "：" in text or mails:
            # a known surname in one trusted context, or any three characters between two
            after = {m.start(1) for m in self.han_after.finditer(text)}
            found += [(*m.span(), "person_name") for m in self.surname.finditer(text) if m.start() in after or text.startswith(self.han_right, m.end())]
            found += [(k, k + 3, "person_name") for k in after if text.startswith(self.han_right, k + 3)]
            if mails:
                found += [(*m.span(1), "person_name") for m in _HAN_MAIL.finditer(text)]
        out: list[tuple[int, int, str]] = []
        for a, b, kind in sorted(found, key=lambda x: (x[0], -x[1])):
            if out and a < out[-1][1]:
                continue
            out.append((a, b, kind))
        return out


def mentions(docs: DataFrame, key: str = "doc_id", text: str = "text", trusted: Trusted | None = None) -> DataFrame:
    """(key, start_char, end_char, line_no, pii_type) of every mention; lines are counted from 1, a mention in two lines counts
    for the first. Null, empty and blank texts have none; rows that come twice are searched twice, so keys should be unique;
    texts are searched whole; other columns are not read; an empty table gives no rows."""
    trusted = trusted or learn(docs, text)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(trusted)
        for batch in batches:
            at, rows = [], []
            for k, t in enumerate(batch.column(1).to_pylist()):
                done, line = 0, 1
                for a, b, what in finder.spans(t):
                    line += t.count("\n", done, a)
                    done = a
                    at.append(k)
                    rows.append((a, b, line, what))
            cols = [pa.array([r[i] for r in rows], (pa.int32(), pa.int32(), pa.int32(), pa.string())[i]) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *cols], [key, "start_char", "end_char", "line_no", "pii_type"])

    return docs.where(F.col(text).isNotNull()).select(key, text).mapInArrow(run, f"`{key}` {kind}, start_char int, end_char int, line_no int, pii_type string")


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text", trusted: Trusted | None = None) -> DataFrame:
    """(key, text, n_replaced): each mention replaced by [EMAIL], [PHONE], [IDENTITY_NUMBER], [STREET_ADDRESS] or
    [PERSON_NAME], the rest unchanged; null texts stay null."""
    trusted = trusted or learn(docs, text)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(trusted)
        for batch in batches:
            texts, counts = [], []
            for t in batch.column(1).to_pylist():
                spans = finder.spans(t) if t else []
                parts, done = [], 0
                for a, b, what in spans:
                    parts += [t[done:a], f"[{what.upper()}]"]
                    done = b
                texts.append("".join(parts) + t[done:] if t is not None else None)
                counts.append(len(spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], [key, text, "n_replaced"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, `{text}` string, n_replaced int")


def found(docs: DataFrame) -> DataFrame:
    return mentions(docs).select("doc_id", "line_no", "pii_type").distinct()
