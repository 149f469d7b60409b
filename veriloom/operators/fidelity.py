"""Is every claim of a page supported, word for word, by the evidence of its key?

Claims and evidence meet on their key (an equi-join), containment is tested within it. Emptiness supports
everything, as the empty string occurs in any text; length floors apply before.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veriloom.functions import claims as C
from veriloom.functions import text as T


#: Bytes of claims, in normal form, that one pass of a keyless search broadcasts; and of claims of two words or fewer, whose automaton is larger.
CLAIM_BYTES, SHORT_BYTES = 32 << 20, 1 << 20
#: Words of a claim that a text is searched for first.
SEED = 4
#: Characters of an address that lead to where it may stand in evidence; address_in finds no shorter one.
SEED_CHARS = 12


def evidence(packets: DataFrame, key: str = "slug", order: str = "path", text: str = "body") -> DataFrame:
    """(key, body): the texts of each key joined by line feeds in order. A key's packets become one row, as a quotation may
    run over them: their number is the bound on a task's memory."""
    return packets.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, text))).alias("t")).select(key, F.array_join(F.transform("t", lambda x: x[text]), "\n").alias("body"))


class Needles:
    """Claims to be found in texts that are parted by single blanks.

    A claim may begin or end inside a word of the text, but its inner words are whole ones: the first SEED of them are its seed. Claims without
    inner words are sought by an automaton over all of them.
    """

    def __init__(self, claims: list[str]):
        self.seeds: dict[int, dict[tuple, list[str]]] = {}
        self.short = [c for c in claims if c.count(" ") < 2]
        for c in claims:
            inner = tuple(c.split(" ")[1:-1])[:SEED]
            if inner:
                self.seeds.setdefault(len(inner), {}).setdefault(inner, []).append(c)
        self.automaton = None

    def found(self, text: str, known: set[str] | None = None) -> list[str]:
        """The claims that a text holds, each once, but those known already."""
        words = text.split(" ")
        out = []
        for k, table in self.seeds.items():
            for seed in table.keys() & zip(*(words[i:] for i in range(k)), strict=False):
                out += [c for c in table[seed] if (known is None or c not in known) and c in text]
        if self.short:
            if self.automaton is None:
                import ahocorasick

                self.automaton = ahocorasick.Automaton()
                for c in self.short:
                    if c:
                        self.automaton.add_word(c, c)
                self.automaton.make_automaton()
            hits = {c for _, c in self.automaton.iter(text)} if len(self.automaton) else set()
            out += [c for c in (hits | {""} if "" in self.short else hits) if known is None or c not in known]
        return out


def contained(claims: DataFrame, texts: DataFrame, claim: str, body: str, key: str | None = None, once: bool = False) -> DataFrame:
    """claims with texts that contain them, both in normal form. Without a key every claim meets every text.

    A keyless search reads the texts once for each CLAIM_BYTES of claims, which are broadcast; texts are never shuffled. once=True: each
    task reports a claim for one of its texts only, which is all that asking whether it is supported takes. Null claims and texts meet nothing.
    """
    c = claims.withColumn("__c", T.norm(claim))
    t = texts.withColumn("__t", T.norm(body))
    if key:
        return c.join(t, key).where(F.contains("__t", "__c")).drop("__c", "__t")
    size = F.octet_length("__c")
    long, short = c.agg(F.sum(size), F.sum(F.when(F.size(F.split("__c", " ")) < 3, size))).first()
    passes = max(1, -(-(long or 0) // CLAIM_BYTES), -(-(short or 0) // SHORT_BYTES))
    c = c.where("__c is not null")
    found = []
    for k in range(passes):
        part = c.where(F.pmod(F.xxhash64("__c"), F.lit(passes)) == k)
        needles = Needles([r[0] for r in part.select("__c").distinct().toLocalIterator()])
        hits = t.mapInArrow(_search(claims.sparkSession.sparkContext.broadcast(needles), once), T.fields([*texts.schema, "__c string"]))
        found.append(hits.join(F.broadcast(part), "__c"))
    return reduce(DataFrame.unionByName, found).drop("__c")


def _search(shared, once: bool):
    """Rows of a text table whose last column is its normal form, by the claims that they hold."""

    def run(batches):
        known: set[str] | None = set() if once else None
        for b in batches:
            rows: list[int] = []
            hits: list[str] = []
            for i, text in enumerate(b.column(b.num_columns - 1)):
                got = shared.value.found(text.as_py(), known) if text.is_valid else []
                rows += [i] * len(got)
                hits += got
                if known is not None:
                    known.update(got)
            part = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(hits, pa.string())], names=[*b.schema.names[:-1], "__c"])

    return run


def unsupported_quotes(quotes: DataFrame, ev: DataFrame, key: str = "slug", quote: str = "text", body: str = "body") -> DataFrame:
    """quotes that the evidence of their key doesn't contain, or whose key has none."""
    e = ev.select(F.col(key).alias("__k"), T.norm(body).alias("__e"))
    return quotes.join(e, (F.col(key) == F.col("__k")) & F.contains("__e", T.strip(T.norm(quote))), "left_anti")


def missing_values(claimed: DataFrame, ev: DataFrame, key: str = "slug", value: str = "value", allow: list[str] | None = None) -> DataFrame:
    """(key, value) of claims that are neither allowed nor among the evidence's values. Both sides are sets."""
    out = claimed.select(key, value).distinct().join(ev.select(key, value).distinct(), [key, value], "left_anti")
    return out.where(~F.col(value).isin(*allow)) if allow else out


def explode_values(df: DataFrame, key: str, values) -> DataFrame:
    return df.select(key, F.explode(values).alias("value"))


def missing_addresses(pages: DataFrame, ev: DataFrame, key: str = "slug", page: str = "raw", body: str = "body") -> DataFrame:
    """Addresses of pages that evidence neither states as such nor holds once whitespace is gone.

    An address begins with a number or ends with one, and address_in takes that number whole: an occurrence begins, or read backwards begins, where
    a run of digits does. Each run's stretch of the longest address asked for is compared once a key, with addresses that share its first SEED_CHARS characters.
    """
    claimed = explode_values(pages, key, C.addresses(page)).distinct()
    known = explode_values(ev, key, C.addresses(body)).distinct()
    left = claimed.join(known, [key, "value"], "left_anti")
    a = left.withColumn("__a", T.no_space("value")).withColumn("back", ~F.col("__a").rlike("^[0-9]")).where(F.length("__a") >= SEED_CHARS)
    longest = a.agg(F.max(F.length("__a"))).first()[0] or SEED_CHARS
    facing = lambda x: F.when(F.col("back"), F.reverse(x)).otherwise(F.col(x))
    sought = a.select(key, "value", "__a", "back", F.substring(facing("__a"), 1, SEED_CHARS).alias("seed"))
    e = ev.select(key, T.no_space(F.lower(body)).alias("e")).where(F.col("e").rlike("[0-9]")).distinct()
    e = e.select(key, F.explode(F.array(F.lit(False), F.lit(True))).alias("back"), "e")
    runs = F.regexp_extract_all(facing("e"), F.lit(rf"(?s)(?<![0-9])(?=([0-9].{{{SEED_CHARS - 1},{longest}}}))"), F.lit(1))
    stretches = e.select(key, "back", F.explode(runs).alias("s")).distinct()
    met = sought.join(stretches.withColumn("seed", F.substring("s", 1, SEED_CHARS)), [key, "back", "seed"])
    held = met.where(F.col("s").startswith(facing("__a"))).where(C.address_in("value", facing("s"))).select(key, "value").distinct()
    return left.join(held, [key, "value"], "left_anti")


def missing_hosts(pages: DataFrame, ev: DataFrame, key: str = "slug", page: str = "raw", body: str = "body", allow: list[str] | None = None) -> DataFrame:
    """Hosts of a page's links that the evidence, headers included, names neither as they are nor without www."""
    claimed = explode_values(pages, key, F.filter(F.transform(C.hrefs(page), C.host), lambda h: h.isNotNull())).distinct()
    if allow:
        claimed = claimed.where(~F.col("value").isin(*allow))
    e = ev.select(F.col(key).alias("__k"), F.lower(body).alias("__e"))
    bare = F.regexp_replace("value", r"^www\.", "")
    return claimed.join(e, (F.col(key) == F.col("__k")) & (F.contains("__e", F.col("value")) | F.contains("__e", bare)), "left_anti")


def advisory(pages: DataFrame, key: str = "slug", text: str = "raw", curly: bool = False) -> DataFrame:
    """(key, phrase): phrases of advice outside quotation marks (ASCII ones; curly=True also masks curly ones)."""
    return pages.select(key, F.explode(advice(text, curly)).alias("phrase"))


def advice(text: str, curly: bool = False) -> Column:
    """The phrases of advice outside a text's quotation marks."""
    masked = F.regexp_replace(T.norm(text), r'"[^"]*"', " ")
    if curly:
        masked = F.regexp_replace(masked, "“[^“”]*”", " ")
    phrases = lambda x: F.filter(F.array(*[F.lit(p) for p in C.ADVISORY]), lambda p: F.contains(x, p))
    return T.let(F.lower(masked), phrases)


def pair_quotes(quotes: DataFrame, index: DataFrame | None, text: str = "raw", state: str = "slug", within: int = 200) -> DataFrame:
    """quotes(state, raw, pos, text) with qid and verdict: the first id within `within` characters after the quotation, and what is wrong.

    UNPAIRED, MALFORMED, CROSS-STATE, UNKNOWN, DUPLICATE in that order of precedence, else null. Only ids
    that are fine otherwise count as used.
    """
    window = F.substr(F.col(text), F.col("pos") + F.length("text") + 1, F.lit(within))
    ids = quotes.withColumn("qid", F.coalesce(F.nullif(F.regexp_extract(window, C.QUOTE_ID, 1), F.lit("")), F.nullif(F.regexp_extract(window, C.QUOTE_ID, 2), F.lit(""))))
    # The first match decides: group 1 of a later match must not win over group 2 of an earlier one.
    first = F.regexp_substr(window, F.lit(C.QUOTE_ID))
    ids = ids.withColumn("qid", F.when(first.startswith("data"), F.regexp_extract(first, C.QUOTE_ID, 1)).when(first.isNotNull(), F.regexp_extract(first, C.QUOTE_ID, 2)))
    if index is not None:
        ids = ids.join(index.select(F.col("id").alias("qid"), F.lit(True).alias("known")).distinct(), "qid", "left")
    else:
        ids = ids.withColumn("known", F.lit(True))
    early = (
        F.when(F.col("qid").isNull(), "UNPAIRED")
        .when(~F.col("qid").rlike(C.QUOTE_ID_SHAPE), "MALFORMED")
        .when(~F.startswith("qid", F.concat(F.col(state), F.lit(":"))), "CROSS-STATE")
        .when(F.col("known").isNull(), "UNKNOWN")
    )
    ids = ids.withColumn("verdict", early).drop("known")
    use = F.row_number().over(Window.partitionBy(state, "qid", F.col("verdict").isNull()).orderBy("pos"))
    return ids.withColumn("verdict", F.when(F.col("verdict").isNull() & (use > 1), "DUPLICATE").otherwise(F.col("verdict")))


def check(pages: DataFrame, packets: DataFrame, index: DataFrame | None = None, allow_hosts: list[str] | None = None, allow_emails: list[str] | None = None) -> DataFrame:
    """(slug, tag, detail): what is unsupported on pages(slug, raw[, lang]), given packets(slug, path, body). Distinct messages, quotations cut to 80 characters.

    PACKET: notes in captured text. QUOTE, PHONE, EMAIL, ADDRESS, HOSTNAME: not in the packets. ADVISORY: advice outside quotations, on English
    pages. On pages of another lang (null: en) each quotation must name an id of the quote index(id): UNPAIRED, MALFORMED, CROSS-STATE,
    UNKNOWN or DUPLICATE says what is wrong with it, INDEX that there is no index. Quotations are read before the change log only, contact
    facts on the whole page; the block that restates a page for search engines is left out.
    """
    lang = F.coalesce("lang", F.lit("en")) if "lang" in pages.columns else F.lit("en")
    raw = T.mask_block("raw", "<!-- search-head -->", "<!-- /search-head -->")
    p = pages.select("slug", lang.alias("lang"), raw.alias("raw")).withColumns({"text": T.mask_tags("raw"), "live": T.mask_tags(C.live_part("raw"))})
    ev = both_evidence(packets)
    notes = ev.select("slug", F.lit("PACKET").alias("tag"), F.explode(F.transform(C.source_notes("region"), lambda a: F.substring(a, 1, 90))).alias("detail"))
    found = [notes, p.join(ev, "slug", "left").select("slug", F.explode(findings(allow_hosts, allow_emails)).alias("f")).select("slug", "f.tag", "f.detail")]
    other = p.where("lang <> 'en'")
    if index is None:
        found.append(other.select("slug", F.lit("INDEX").alias("tag"), F.lit("there is no quote index").alias("detail")))
    q = other.select("slug", F.col("text").alias("window"), F.explode(C.quotes("live")).alias("q")).select("slug", "window", "q.pos", "q.text")
    paired = pair_quotes(q, index, "window", "slug").where("verdict is not null")
    found.append(paired.select("slug", F.col("verdict").alias("tag"), F.when(F.col("verdict") == "UNPAIRED", F.substring("text", 1, 70)).otherwise(F.col("qid")).alias("detail")))
    return reduce(DataFrame.unionByName, found).distinct()


def both_evidence(packets: DataFrame) -> DataFrame:
    """(slug, region, bodies) of packets(slug, path, body): what evidence() makes of their source regions and of their source bodies, in one grouping."""
    from veriloom.sources.packets import source_bodies, source_region

    each = F.struct("path", source_region("body").alias("region"), source_bodies("body").alias("bodies"))
    ordered = packets.groupBy("slug").agg(F.array_sort(F.collect_list(each)).alias("t"))
    text = lambda k: F.array_join(F.transform("t", lambda x: x[k]), "\n").alias(k)
    return ordered.select("slug", text("region"), text("bodies"))


def findings(allow_hosts: list[str] | None, allow_emails: list[str] | None) -> Column:
    """array<struct<tag, detail>> of a page's row (lang, raw, text, live) beside its evidence (region, bodies; null: none): each fact of the page against
    those of the evidence, which are taken from it once."""
    none = F.expr("cast(array() as array<string>)")
    bodies, region = F.coalesce("bodies", F.lit("")), F.coalesce("region", F.lit(""))
    known = F.struct(
        T.norm("bodies").alias("normal"), C.phones(bodies).alias("phones"), C.emails(bodies).alias("emails"), C.addresses(bodies).alias("addresses"), F.lower(region).alias("lower"), F.col("bodies").isNull().alias("absent")
    )
    named = F.filter(F.transform(C.hrefs("raw"), C.host), lambda h: h.isNotNull())
    but = lambda c, allowed: F.array_except(c, F.array(*[F.lit(x) for x in allowed])) if allowed else F.array_distinct(c)
    quoted = F.transform(C.quotes("live"), lambda q: q["text"])
    said = F.struct(
        quoted.alias("quotes"), C.page_phones("text", "raw").alias("phones"), but(C.page_emails("text", "raw"), allow_emails).alias("emails"), C.addresses("text").alias("addresses"), but(named, allow_hosts).alias("hosts"),
        F.when(F.col("lang") == "en", advice("text")).otherwise(none).alias("advice"),
    )

    def missing(s: Column, k: Column) -> Column:
        held = lambda h: F.contains(k["lower"], h) | F.contains(k["lower"], F.regexp_replace(h, r"^www\.", ""))
        of = {
            "QUOTE": F.transform(F.filter(s["quotes"], lambda q: k["absent"] | ~F.contains(k["normal"], T.strip(T.norm(q)))), lambda q: F.substring(q, 1, 80)),
            "PHONE": F.array_except(s["phones"], k["phones"]),
            "EMAIL": F.array_except(s["emails"], k["emails"]),
            "ADDRESS": F.filter(F.array_except(s["addresses"], k["addresses"]), lambda a: k["absent"] | ~C.address_in(a, F.coalesce("bodies", F.lit("")))),
            "HOSTNAME": F.filter(s["hosts"], lambda h: k["absent"] | ~held(h)),
            "ADVISORY": s["advice"],
        }
        tagged = lambda tag, c: F.transform(c, lambda d: F.struct(F.lit(tag).alias("tag"), d.alias("detail")))
        return F.concat(*[tagged(tag, c) for tag, c in of.items()])

    return T.let(known, lambda k: T.let(said, lambda s: missing(s, k)))


def coverage(pages: DataFrame, index: DataFrame) -> DataFrame:
    """(slug, paired, in_scope): how many of the index's spans(id, state, in_scope) pages of another language carry, of those in scope."""
    text = pages.where("lang <> 'en'").withColumns({"window": T.mask_tags("raw"), "live": T.mask_tags(C.live_part("raw"))})
    q = text.select("slug", "window", F.explode(C.quotes("live")).alias("q")).select("slug", "window", "q.pos", "q.text")
    n = pair_quotes(q, index, "window", "slug").where("verdict is null").groupBy("slug").agg(F.count_distinct("qid").alias("paired"))
    wanted = index.where("in_scope").groupBy(F.col("state").alias("slug")).agg(F.count_distinct("id").alias("in_scope"))
    return text.select("slug").distinct().join(n, "slug", "left").join(wanted, "slug", "left").select("slug", F.coalesce("paired", F.lit(0)).alias("paired"), F.coalesce("in_scope", F.lit(0)).alias("in_scope"))


def quote_index(text: DataFrame, column: str = "value") -> DataFrame:
    """(id, state, in_scope, text) of an index's JSON lines; of lines that repeat an id the last in order of text counts, blank lines don't."""
    r = text.where(F.trim(column) != "").select(F.from_json(column, "id string, state string, in_scope boolean, text string", {"mode": "FAILFAST"}).alias("r"), F.col(column).alias("line"))
    return r.groupBy("r.id").agg(F.max_by("r", "line").alias("r")).select("r.*")


def exit_code(findings: DataFrame) -> int:
    """0: nothing is unsupported; 1: something is."""
    return 0 if findings.isEmpty() else 1
