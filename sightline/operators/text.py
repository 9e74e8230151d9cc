"""Text intelligence: indicators, keywords and sentences in reports, page parsing, similarity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions.columns import blank_to_null
from ..session import pin, scratch_path
from .similar import similar_items  # noqa: F401 (part of this module's interface)

# fixed values ---------------------------------------------------------------------------------
# (?U): word boundaries, digits and spaces follow Unicode
IOC_PATTERNS = {
    "ips": r"(?U)\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b",
    "domains": r"(?U)\b(?!(?:\d+\.){3}\d+)(?:[a-zA-Z0-9-]++\.)+[a-zA-Z]{2,}\b",
    "urls": r"(?U)\bhttps?://[^\s\"\)\]\}<>]+",
    "emails": r"(?U)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
    "md5": r"(?U)\b[a-fA-F0-9]{32}\b",
    "sha1": r"(?U)\b[a-fA-F0-9]{40}\b",
    "sha256": r"(?U)\b[a-fA-F0-9]{64}\b",
}
INTEL_PORTALS = (
    "otx.alienvault.com", "abuseipdb.com", "virustotal.com", "urlscan.io", "censys.io",
    "shodan.io", "talosintelligence.com", "threatfox", "misp", "bazaar.abuse.ch", "app.any.run",
    "phishtank", "greynoise.io", "abuse.ch",
)
FILLERS = ("adversaries", "may", "possibly", "can", "could", "might")
ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®",
    "trade": "™", "middot": "·", "bull": "•", "hellip": "…", "ndash": "–",
    "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "laquo": "«", "raquo": "»", "euro": "€", "pound": "£", "sect": "§",
}
# ----------------------------------------------------------------------------------------------
SPACES = r"(?U)\s+"


def find_all(text: Column, pattern: str) -> Column:
    """Distinct matches in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def words(text: Column) -> Column:
    """Whitespace-separated words."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def collapse(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, SPACES, " "), "^ | $", "")


def _ascii(pattern: str) -> str:
    """The pattern with word boundaries between ASCII word characters and anything else."""
    w = "[0-9A-Za-z_]"
    return pattern.removeprefix("(?U)").replace(r"\b", f"(?:(?<!{w})(?={w})|(?<={w})(?!{w}))")


def extract_iocs(df: DataFrame, col: str, unicode: bool = True) -> DataFrame:
    """Addresses, domains, URLs, e-mails and hashes in a text, as a nested ``iocs`` column.

    Without ``unicode``, a letter beyond ASCII ends a word: ``größe.example`` names a domain ``e.example``.
    """
    patterns = IOC_PATTERNS if unicode else {name: _ascii(p) for name, p in IOC_PATTERNS.items()}
    text, none = F.col(col), F.array().cast("array<string>")
    # a cheap necessary condition spares most texts the full pattern
    hint = {"emails": text.contains("@"), "urls": text.contains("http")}
    for name in ("md5", "sha1", "sha256"):
        hint[name] = text.rlike("[a-fA-F0-9]{32}")
    hint["ips"] = text.rlike(r"(?U)\d\.\d")
    hint["domains"] = text.rlike(r"[a-zA-Z0-9-]\.[a-zA-Z0-9-]")
    found = {
        name: F.when(hint[name], find_all(text, pattern)).otherwise(F.when(text.isNotNull(), none))
        for name, pattern in patterns.items()
    }
    hashes = F.struct(*[found[h].alias(h) for h in ("md5", "sha1", "sha256")])
    plain = [found[n].alias(n) for n in ("ips", "domains", "urls", "emails")]
    return df.withColumn("iocs", F.struct(*plain, hashes.alias("hashes")))


def refang(df: DataFrame, col: str) -> DataFrame:
    """``1[.]2`` → ``1.2``; ``is_bracketed`` says whether the text was defanged."""
    c = F.col(col)
    bracketed = c.contains("[") & c.contains(".") & c.contains("]") & c.rlike(r"\d")
    return df.withColumn("is_bracketed", F.coalesce(bracketed, F.lit(False))).withColumn(
        col, F.regexp_replace(F.trim(c), r"\[(\.|:)\]", "$1")
    )


def _counted(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """``terms`` per document: its distinct tokens in order, each with its count and first position.

    A document is counted inside its own row, so no term is exchanged.  Texts that share a key are put
    together first; the keys alone tell whether any do.
    """
    rows = df.select(key, F.coalesce(tokens, F.array().cast("array<string>")).alias("tokens"))
    if not df.groupBy(key).count().where("count > 1").isEmpty():
        rows = rows.groupBy(key).agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
    pairs = F.sort_array(F.transform("tokens", lambda t, i: F.struct(t.alias("token"), i.alias("first"))))
    rows = rows.select(key, pairs.alias("pairs"))
    # the start of every run of equal tokens, then the lengths of the runs
    at = F.filter(
        F.transform("pairs", lambda p, i: F.when((i == 0) | (F.get("pairs", i - 1)["token"] != p["token"]), i)),
        lambda i: i.isNotNull(),
    )
    rows = rows.select(key, "pairs", at.alias("at"))
    run = lambda i, j: F.struct(
        F.get("pairs", i)["token"].alias("token"),
        (F.coalesce(F.get("at", j + 1), F.size("pairs")) - i).alias("tf"),
        F.get("pairs", i)["first"].alias("first"),
    )
    return rows.select(key, F.transform("at", run).alias("terms"))


def _top_terms(terms: DataFrame, key: str, order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order))
    top = terms.withColumn("_rank", rank).where(F.col("_rank") <= n)
    # at most n entries per document; the null of an empty document is dropped here
    ranked = F.array_sort(F.collect_list(F.when(F.col("token").isNotNull(), F.struct("_rank", "token"))))
    return top.groupBy(key).agg(F.transform(ranked, lambda t: t["token"]).alias("keywords"))


def extract_keywords(df: DataFrame, col: str, n: int = 10, key: str = "doc_id") -> DataFrame:
    """The ``n`` most frequent words of four letters or more; ties by first appearance."""
    tokens = F.regexp_extract_all(F.lower(col), F.lit("[A-Za-z]{4,}"), F.lit(0))
    rows = _counted(df, key, tokens)
    ranked = F.sort_array(F.transform("terms", lambda t: F.struct((-t["tf"]).alias("n"), t["first"], t["token"])))
    return rows.select(key, F.transform(F.slice(ranked, 1, n), lambda t: t["token"]).alias("keywords"))


COMMON_TERMS = 100_000  # terms whose document frequency is broadcast


def tfidf_keywords(
    df: DataFrame, col: str, n: int = 10, key: str = "doc_id", stop_words: Sequence[str] | None = None
) -> DataFrame:
    """Top terms by tf·idf over the corpus, with ``idf = ln((1+N)/(1+df)) + 1``.

    Every word of the corpus counts; there is no vocabulary limit.  ``stop_words`` defaults to
    Spark's English list.  The frequencies of the most common terms are broadcast; only the other terms,
    each in few documents, are joined by a shuffle, and of the common ones a task passes on ``n`` a document.
    """
    spark = df.sparkSession
    stop = StopWordsRemover.loadDefaultStopWords("english") if stop_words is None else list(stop_words)
    tokens = F.regexp_extract_all(F.lower(col), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    # written in columns, as the document frequencies and the result read it
    path = scratch_path(spark, "terms")
    _counted(df, key, F.filter(tokens, lambda t: ~t.isin(*stop))).select(
        key, F.transform("terms", lambda t: F.struct(t["token"], t["tf"])).alias("terms")
    ).write.parquet(path)
    documents = spark.read.parquet(path)
    terms = documents.select(key, F.inline_outer("terms"))
    frequency = pin(terms.where("token IS NOT NULL").groupBy("token").agg(F.count("*").alias("df")))
    common = frequency
    if frequency.count() > COMMON_TERMS:
        common = pin(frequency.orderBy(F.col("df").desc(), "token").limit(COMMON_TERMS))
    total = documents.count()
    known = terms.join(F.broadcast(common), "token", "left")
    if common is not frequency:
        rare = known.where("df IS NULL AND token IS NOT NULL").drop("df").join(frequency, "token")
        known = known.where("df IS NOT NULL OR token IS NULL").unionByName(rare)
    idf = F.log((1 + F.lit(total)) / (1 + F.col("df"))) + 1
    # rounded, so equal weights stay equal whatever the order of multiplication
    weighted = known.withColumn("weight", F.round(F.col("tf") * idf, 6))
    return _top_terms(weighted, key, [F.col("weight").desc_nulls_last(), F.col("token")], n)


def text_stats(df: DataFrame, col: str) -> DataFrame:
    """Word, character and sentence counts of the whitespace-collapsed text."""
    clean = collapse(F.col(col))
    sentences = F.filter(F.split(clean, r"(?<=[.!?])\s+"), lambda s: F.trim(s) != "")
    counted = df.withColumns(
        {
            "word_count": F.size(words(clean)),
            "char_count": F.length(clean),
            "sentence_count": F.size(sentences),
        }
    )
    # two decimals in whole numbers, ties upwards, so no binary fraction decides
    n, k = F.col("word_count").cast("long"), F.col("sentence_count").cast("long")
    mean = F.floor((200 * n + k) / (2 * k)) / 100
    return counted.withColumn("words_per_sentence", F.when(k > 0, mean).otherwise(0.0))


def split_sentences(df: DataFrame, col: str) -> DataFrame:
    """One row per sentence, split after ``.!?`` and white space."""
    sentences = F.filter(F.split(collapse(F.col(col)), r"(?<=[.!?])\s+"), lambda s: F.trim(s) != "")
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.posexplode(sentences).alias("position", "sentence"))


# --------------------------------------------------------------------------------------- pages


def unescape(text: Column) -> Column:
    """Decode numeric character references and the common named ones."""
    pieces = F.split(text, "&#")

    def numeric(piece: Column) -> Column:
        hexa = F.regexp_extract(piece, r"^[xX]([0-9a-fA-F]{1,6});", 1)
        deci = F.regexp_extract(piece, r"^([0-9]{1,7});", 1)
        code = F.when(hexa != "", F.conv(hexa, 16, 10)).when(deci != "", deci).cast("long")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        tail = F.regexp_replace(piece, r"^[xX]?[0-9a-fA-F]{1,7};", "")
        return F.when(valid, F.concat(char, tail)).otherwise(F.concat(F.lit("&#"), piece))

    joined = F.concat(
        F.get(pieces, 0), F.array_join(F.transform(F.slice(pieces, 2, 1_000_000_000), numeric), "")
    )
    out = F.when(text.contains("&#"), joined).otherwise(text)
    for name, char in ENTITIES.items():
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def visible_text(html: Column) -> Column:
    """Text of an html fragment without comments, scripts and styles, white space collapsed."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"(?is)<(script|style|template)\b.*?</\1\s*>", " ")
    bare = F.regexp_replace(bare, r"(?s)<[!/?a-zA-Z][^>]*>", " ")
    return collapse(unescape(bare))


def _meta(html: Column, attribute: str, value: str) -> Column:
    """``content`` of the first meta tag with the attribute value, whatever the attribute order."""
    tag = F.regexp_extract(
        html, rf"""(?is)<meta\b(?=[^>]*\b{attribute}\s*=\s*["']{value}["'])[^>]*>""", 0
    )
    double = F.regexp_extract(tag, r'(?is)\bcontent\s*=\s*"([^"]*)"', 1)
    single = F.regexp_extract(tag, r"(?is)\bcontent\s*=\s*'([^']*)'", 1)
    return F.nullif(F.trim(unescape(F.coalesce(F.nullif(double, F.lit("")), single))), F.lit(""))


def _json_ld_date(html: Column) -> Column:
    """Publication date of the first JSON-LD article object."""
    blocks = F.regexp_extract_all(
        html, F.lit(r"""(?is)<script\b[^>]*ld\+json[^>]*>(.*?)</script>"""), F.lit(1)
    )
    item = "struct<`@type`:string,datePublished:string,`@graph`:array<struct<`@type`:string>>>"
    objects = F.flatten(
        F.transform(blocks, lambda b: F.coalesce(F.from_json(F.trim(b), f"array<{item}>"), F.array()))
    )
    kind = lambda o: F.lower(F.coalesce(o["@type"], F.get(o["@graph"], 0)["@type"]))
    # a list of types arrives as its JSON text
    articles = F.filter(objects, lambda o: kind(o).rlike(r'article"?\s*(,|\]|$)'))
    return F.get(articles, 0)["datePublished"]


def page_metadata(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Host, title, description, social tags, publication time and a 200-word excerpt."""
    page = F.col(html)
    title = collapse(unescape(F.regexp_extract(page, r"(?is)<title\b[^>]*>(.*?)</title>", 1)))
    return df.withColumns(
        {
            "domain": url_parts(F.col(url))["authority"],
            "title_tag": F.nullif(title, F.lit("")),
            "meta_description": _meta(page, "name", "description"),
            "og_title": _meta(page, "property", "og:title"),
            "og_description": _meta(page, "property", "og:description"),
            "og_site_name": _meta(page, "property", "og:site_name"),
            "published_time": F.coalesce(_meta(page, "property", "article:published_time"), _json_ld_date(page)),
            "excerpt": F.array_join(F.slice(words(visible_text(page)), 1, 200), " "),
        }
    )


def _balanced_div(html: Column, css_class: str) -> Column:
    """Inside of the first div with the class, up to its own closing tag; none → empty."""
    start = rf"""(?is)<div\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["'][^>]*>.*"""
    pieces = F.split(F.regexp_extract(html, start, 0), r"(?i)(?=<div\b|</div\b)")
    zero = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit("").alias("text"))

    def step(acc: Column, piece: Column) -> Column:
        change = F.when(piece.rlike(r"(?i)^<div\b"), 1).when(piece.rlike(r"(?i)^</div\b"), -1).otherwise(0)
        depth = acc["depth"] + change
        done = acc["done"] | ((change == -1) & (depth <= 0))
        text = F.when(done, acc["text"]).otherwise(F.concat(acc["text"], piece))
        return F.struct(depth.alias("depth"), done.alias("done"), text.alias("text"))

    return F.aggregate(pieces, zero, step, lambda acc: acc["text"])


def page_text(df: DataFrame, html: str = "html") -> DataFrame:
    """Article text (article, body div or whole page) and its first 50 words."""
    page = F.col(html)
    article = F.regexp_extract(page, r"(?is)<article\b[^>]*>(.*?)</article\s*>", 1)
    chosen = (
        F.when(page.rlike(r"(?i)<article\b"), article)
        .when(page.rlike(r"""(?i)<div\b[^>]*\bclass\s*=\s*["'][^"']*\barticle-body\b"""), _balanced_div(page, "article-body"))
        .when(page.rlike(r"""(?i)<div\b[^>]*\bclass\s*=\s*["'][^"']*\bcontent\b"""), _balanced_div(page, "content"))
    )
    body = F.when(F.coalesce(chosen, F.lit("")) != "", chosen).otherwise(page)
    return df.withColumn("text", visible_text(body)).withColumn(
        "summary", F.array_join(F.slice(words(F.col("text")), 1, 50), " ")
    )


# ------------------------------------------------------------------------------------ addresses


def url_parts(url: Column) -> dict[str, Column]:
    """Scheme, authority, path and query of an address (empty where absent)."""
    pattern = r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
    names = ("scheme", "authority", "path", "query")
    return {name: F.regexp_extract(url, pattern, i) for i, name in enumerate(names, 1)}


def host_of(url: Column) -> Column:
    authority = F.regexp_replace(url_parts(url)["authority"], r"^[^@]*@", "")
    return F.lower(F.regexp_replace(authority, r":\d*$", ""))


def normalize_url(df: DataFrame, col: str, out: str = "url_normalized") -> DataFrame:
    """Lower-case scheme and host, no default port, fragment, parameters or trailing slash."""
    parts = url_parts(F.col(col))
    scheme = F.lower(parts["scheme"])
    port = F.regexp_extract(parts["authority"], r":0*(\d+)$", 1)
    default = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    authority = F.concat(host_of(F.col(col)), F.when(default, "").otherwise(F.concat(F.lit(":"), port)))
    path = F.regexp_replace(parts["path"], r";[^/]*$", "")
    path = F.when(path == "", "/").when(path == "/", "/").otherwise(F.regexp_replace(path, "/+$", ""))
    query = F.when(parts["query"] != "", F.concat(F.lit("?"), parts["query"])).otherwise("")
    prefix = F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise("")
    slashes = F.when(authority != "", F.concat(F.lit("//"), authority)).otherwise("")
    return df.withColumn(out, F.concat(prefix, slashes, path, query))


def blocked_domain(df: DataFrame, col: str, hosts: Sequence[str]) -> DataFrame:
    """Whether the host is one of ``hosts`` or below one of them."""
    host, hit = host_of(F.col(col)), F.lit(False)
    for name in hosts:
        hit = hit | (host == name) | host.endswith("." + name)
    return df.withColumn("is_blocked", F.coalesce(hit, F.lit(False)))


def intel_domain(df: DataFrame, col: str, hosts: Sequence[str] = INTEL_PORTALS) -> DataFrame:
    """Whether the host contains the name of an intelligence portal."""
    host, hit = host_of(F.col(col)), F.lit(False)
    for name in hosts:
        hit = hit | host.contains(name)
    return df.withColumn("is_intel", F.coalesce(hit, F.lit(False)))


# ------------------------------------------------------------------------------ comments, reports


def _clean_comment(text: Column, n: int) -> Column:
    out = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?iU)\bshow\s+(more|less)\b", "")
    out = F.regexp_replace(out, r"(?U)\S+@\S+", "")
    out = collapse(F.regexp_replace(out, r"(?U)https?://\S+", ""))
    return F.when(F.length(out) > n, F.concat(F.substring(out, 1, n - 1), F.lit("…"))).otherwise(out)


def clean_comment(df: DataFrame, col: str, n: int = 200) -> DataFrame:
    """Drop "show more/less", e-mails and URLs, collapse white space, cut to ``n`` characters."""
    return df.withColumn(col, _clean_comment(F.col(col), n))


def _category_name(name: Column) -> Column:
    """Capitalised words; words with a capital after their first letter stay as they are."""

    def title(token: Column) -> Column:
        rest = F.substr(token, F.lit(2))
        return F.when(rest.rlike(r"\p{Lu}"), token).otherwise(F.concat(F.upper(F.substring(token, 1, 1)), F.lower(rest)))

    return F.array_join(F.transform(words(name), title), " ")


def report_categories(df: DataFrame, key: str, comment: str = "comment", categories: str = "categories") -> DataFrame:
    """Distinct report lines ``[Category, …] comment`` per key."""
    names = F.filter(F.transform(F.coalesce(categories, F.array()), _category_name), lambda c: c != "")
    rows = df.select(key, F.array_distinct(names).alias("categories"), _clean_comment(F.col(comment), 200).alias("comment"))
    label = F.concat(F.lit("["), F.array_join("categories", ", "), F.lit("] "), F.col("comment"))
    line = F.when(F.size("categories") > 0, label).otherwise(F.col("comment"))
    return rows.withColumn("line", line).where("line <> ''").distinct()


def category_counts(df: DataFrame, key: str, categories: str = "categories") -> DataFrame:
    """Uses of each normalised category per key."""
    names = df.select(key, F.explode(categories).alias("_c")).select(key, _category_name(F.col("_c")).alias("category"))
    return names.where("category <> ''").groupBy(key, "category").agg(F.count("*").alias("n"))


# ------------------------------------------------------------------------------------ techniques


def clean_technique_text(df: DataFrame, col: str) -> DataFrame:
    """Strip tags, entities, markdown links, code ticks, citations and filler words."""
    out = F.regexp_replace(F.coalesce(F.col(col), F.lit("")), r"<.*?>", "")
    out = unescape(out)
    out = F.regexp_replace(out, r"\[([^\]]+)\]\([^)]+\)", "$1")
    out = F.regexp_replace(out, r"`([^`]+)`", "$1")
    out = F.regexp_replace(out, r"\(Citation:.*?\)", "")
    out = F.regexp_replace(out, rf"(?iU)\b({'|'.join(FILLERS)})\b", "")
    return df.withColumn(col, collapse(out))


def technique_actors(objects: DataFrame, rels: DataFrame) -> DataFrame:
    """Distinct actor names per technique from "uses" relations of groups to techniques."""
    uses = rels.where(
        (F.col("relationship_type") == "uses")
        & F.col("source_ref").startswith("intrusion-set")
        & F.col("target_ref").startswith("attack-pattern")
    )
    actors = objects.where("type = 'intrusion-set' AND name IS NOT NULL").select(
        F.col("id").alias("source_ref"), F.col("name").alias("actor")
    )
    named = uses.join(actors, "source_ref").groupBy("target_ref").agg(
        F.array_sort(F.collect_set("actor")).alias("actors")
    )
    techniques = objects.where("type = 'attack-pattern'").select(F.col("id").alias("technique_id"), "name")
    out = techniques.join(named, F.col("technique_id") == F.col("target_ref"), "left").drop("target_ref")
    return out.withColumn("actors", F.coalesce("actors", F.array().cast("array<string>")))


def tactic_rollup(matches: DataFrame, dictionary: DataFrame) -> DataFrame:
    """One row per tactic of every match, sorted."""
    known = dictionary.select("item_id", "name", "tactics")
    rows = matches.join(known, "item_id").select(
        "id", F.explode("tactics").alias("tactic"), "item_id", "name", "similarity"
    )
    return rows.orderBy("tactic", "item_id", "id")


def actor_dictionary(*lists: DataFrame, col: str = "name") -> DataFrame:
    """Distinct non-blank actor names of all lists, sorted."""
    out = lists[0].select(col)
    for other in lists[1:]:
        out = out.unionByName(other.select(col))
    return out.select(blank_to_null(F.col(col)).alias(col)).where(f"{col} IS NOT NULL").distinct().orderBy(col)


def flag_long_enough(
    df: DataFrame, text: str = "text", url: str = "url", min_words: int = 100, iocs: str | None = None,
    hosts: Sequence[str] = INTEL_PORTALS, kinds: Sequence[str] = tuple(IOC_PATTERNS),
) -> DataFrame:
    """Valid when long enough, or, with an ``iocs`` column, a page of a portal in ``hosts`` that names
    indicators of one of the ``kinds``."""
    valid = F.size(words(F.col(text))) >= min_words
    if iocs:
        hashes = ("md5", "sha1", "sha256")
        flat = F.flatten(F.array(*[F.col(f"{iocs}.hashes.{k}" if k in hashes else f"{iocs}.{k}") for k in kinds]))
        df = intel_domain(df, url, hosts)
        valid = valid | (F.col("is_intel") & (F.size(flat) > 0))
    return df.withColumn("is_valid", F.coalesce(valid, F.lit(False)))
