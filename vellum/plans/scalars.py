"""Queries of the scalar functions, one row a document, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.functions import text as T
from vellum.plans.registry import query, table
from vellum.sources.readers import balanced

#: The text with links, headings and emphasis put in, in both languages.
MARKED_SQL = r"""'# Note' || chr(10) || replace(replace(replace(text, ' the ', ' [[concepts/the-one|the]] '), ' of ', ' **of** '), ' de ', ' [[topos/de-la]] ')"""
TITLE_SQL = "substr(string_split(text, chr(10))[1], 1, 60)"
FLESCH_SQL = "(CASE WHEN n_chars % 11 = 0 THEN NULL ELSE n_chars % 120 - 5 END)::DOUBLE"
FILE_SQL = "(CASE doc_id % 9 WHEN 0 THEN 'part_' || doc_id WHEN 1 THEN 'Chapter_' || doc_id || '_x.md' WHEN 2 THEN 'Story_' || doc_id WHEN 3 THEN 'Section_' || doc_id || '.md' WHEN 4 THEN 'Scene_' || doc_id || 'a' WHEN 5 THEN 'scene_' || doc_id || '.md' WHEN 6 THEN 'Act_' || doc_id WHEN 7 THEN 'Prologue' ELSE 'Sonnet_' || doc_id END)"
BASE = f"base AS (SELECT doc_id, text, lang, source, n_chars, {MARKED_SQL} AS marked, {TITLE_SQL} AS title, {FLESCH_SQL} AS flesch, {FILE_SQL} AS file FROM documents)"


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = balanced(table(spark, sf_dir, "documents"))
    marked = F.concat(F.lit("# Note\n"), F.col("text"))
    for raw, put in ((" the ", " [[concepts/the-one|the]] "), (" of ", " **of** "), (" de ", " [[topos/de-la]] ")):
        marked = F.replace(marked, F.lit(raw), F.lit(put))
    title = F.substring(F.split_part("text", F.lit("\n"), F.lit(1)), 1, 60)
    flesch = F.when(F.col("n_chars") % 11 != 0, F.col("n_chars") % 120 - 5).cast("double")
    n = F.col("doc_id").cast("string")
    names = [F.concat(F.lit("part_"), n), F.concat(F.lit("Chapter_"), n, F.lit("_x.md")), F.concat(F.lit("Story_"), n), F.concat(F.lit("Section_"), n, F.lit(".md")), F.concat(F.lit("Scene_"), n, F.lit("a")), F.concat(F.lit("scene_"), n, F.lit(".md")), F.concat(F.lit("Act_"), n), F.lit("Prologue"), F.concat(F.lit("Sonnet_"), n)]
    file = F.element_at(F.array(*names), (F.col("doc_id") % 9 + 1).cast("int"))
    return docs.select("doc_id", "text", "lang", "source", "n_chars", marked.alias("marked"), title.alias("title"), flesch.alias("flesch"), file.alias("file"))


def scalar(name: str, make: Callable[[], Column], sql: str) -> None:
    oracle = f"WITH {BASE} SELECT doc_id, {sql} AS value FROM base"

    @query(name, oracle)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return base(spark, sf_dir).select("doc_id", make().alias("value"))


C = F.col
RX = "regexp_replace({}, '{}', '{}', 'g')"


def rx(x: str, *steps: tuple[str, str]) -> str:
    for pattern, put in steps:
        x = f"regexp_replace({x}, '{pattern}', '{put}', 'g')"
    return x


def listed(column: Column) -> Column:
    return F.array_join(column, "|")


scalar("fn_slug_site", lambda: T.slug_site(F.concat(C("source"), F.lit("/A & B 50%?/"), C("title"))), "lower(" + rx(r"source || '/A & B 50%?/' || title", (r"\s", "-"), ("&", "-and-"), ("%", "-percent"), ("[?#]", "")) + ")")
scalar("fn_slug_snake", lambda: T.slug_snake(C("title")), rx("lower(title)", ("[^a-z0-9]+", "_"), ("^_+|_+$", "")))
_WHOLE = rx("lower(substr(text, 1, 90))", ("[·’'']", ""), ("[^a-z0-9]+", "-"), ("^-+|-+$", ""))
scalar("fn_slug_60", lambda: T.slug_60(F.substring("text", 1, 90)), f"(SELECT CASE WHEN length(w) <= 60 THEN w ELSE regexp_replace(CASE WHEN instr(c, '-') > 0 AND length(c) - instr(reverse(c), '-') > 30 THEN substr(c, 1, length(c) - instr(reverse(c), '-')) ELSE c END, '-+$', '') END FROM (SELECT {_WHOLE} AS w, substr({_WHOLE}, 1, 60) AS c))")
scalar("fn_slug_author", lambda: T.slug_author(C("title")), rx("lower(title)", (r"\s+", "-")))
scalar("fn_norm_id", lambda: T.norm_id(F.concat(F.lit("./"), C("source"), F.lit(".html#"), C("doc_id"))), "source || '#' || doc_id")
scalar("fn_base_work", lambda: T.base_work(F.concat(C("source"), F.lit("#"), C("doc_id"))), "source")
scalar("fn_section_key", lambda: T.section_key(F.concat(C("source"), F.lit("--part_"), C("doc_id"))), "source")
scalar("fn_no_article", lambda: T.no_article(F.concat(F.lit("The "), C("title"))), "trim(" + rx("lower('The ' || title)", (r"^\s*(the|a|an)\s+", "")) + ")")
scalar("fn_author_key", lambda: T.author_key(F.concat(C("source"), F.lit("_ X__Y "))), "trim(" + rx("lower(source || '_ X__Y ')", (r"[_\s]+", " ")) + ")")
scalar("fn_author_display", lambda: T.author_display(F.concat(F.lit("testi/van_"), C("source"), F.lit("/x")), F.when(C("doc_id") % 2 == 0, F.array(F.lit("a/b"), F.concat(F.lit("author/o_"), C("source")))).otherwise(F.array(F.lit("a/b")))), "CASE WHEN doc_id % 2 = 0 THEN 'O S' ELSE 'Van S' END || substr(source, 2)")
scalar("fn_human_pretty", lambda: T.pretty(F.concat(C("lang"), F.lit("_of_"), C("source"))), "upper(substr(lang, 1, 1)) || substr(lang, 2) || ' of ' || source")
scalar("fn_title_norm", lambda: T.title_norm(F.concat(C("title"), F.lit(" — ’x’ [[|]](Part 3)..."))), rx("lower(" + rx("title || ' — ’x’ [[|]](Part 3)...'", (r"\[\[\s*\|?\s*\]\]", ""), ("[–—]", "-"), ("[‘’]", "''"), ("[“”]", '"'), (r"(?i)\s*\(part\s+\d+\)", "")) + ")", (r"\s+", " "), (r"^ +|[ .…]+$", "")))
_SHOWN = rx("marked", (r"\[\[[^\[\]|]*\|([^\[\]]*)\]\]", r"\1"), (r"\[\[([^\[\]|]*)\]\]", r"\1"))
scalar("fn_row_norm", lambda: F.md5(T.row_norm(C("marked"))), "md5(trim(" + rx(_SHOWN, (r"\b\d+\.\d+\b", ""), (r"\s+", " ")) + "))")
scalar("fn_esc_html", lambda: T.esc_html(F.concat(F.lit('<a href="'), C("title"), F.lit('">&'))), "'&lt;a href=&quot;' || replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') || '&quot;&gt;&amp;'")
scalar("fn_highlight", lambda: T.highlight(C("title"), "The"), "(SELECT CASE WHEN instr(lower(s), 'the') > 0 THEN substr(s, 1, instr(lower(s), 'the') - 1) || '<mark>' || substr(s, instr(lower(s), 'the'), 3) || '</mark>' || substr(s, instr(lower(s), 'the') + 3) ELSE s END FROM (SELECT replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;') AS s))")
_CEFR = "CASE WHEN flesch IS NULL OR flesch < 0 OR flesch > 100 THEN '' WHEN flesch >= 80 THEN 'A2' WHEN flesch >= 70 THEN 'B1' WHEN flesch >= 60 THEN 'B2' WHEN flesch >= 45 THEN 'C1' ELSE 'C2' END"
scalar("fn_cefr", lambda: T.cefr(C("flesch")), _CEFR)
scalar("fn_cefr_rank", lambda: T.cefr_rank(C("flesch")), f"CASE {_CEFR} WHEN 'A2' THEN 0 WHEN 'B1' THEN 1 WHEN 'B2' THEN 2 WHEN 'C1' THEN 3 WHEN 'C2' THEN 4 ELSE 'infinity'::DOUBLE END::DOUBLE")
scalar("fn_classify_unit", lambda: F.concat_ws(":", T.classify_unit(C("file"))[0], F.format_string("%.2f", T.classify_unit(C("file"))[1])), "CASE doc_id % 9 WHEN 0 THEN 'excerpt:' WHEN 1 THEN 'chapter:' WHEN 2 THEN 'story:' WHEN 3 THEN 'section:' WHEN 8 THEN 'work:' ELSE 'scene:' END || printf('%.2f', CASE doc_id % 9 WHEN 4 THEN doc_id + 0.01 WHEN 6 THEN 100 + doc_id WHEN 7 THEN 100 WHEN 8 THEN 0 ELSE doc_id END::DOUBLE)")
scalar("fn_public_domain", lambda: T.public_domain_from(F.date_add(F.lit("1850-06-01").cast("date"), (C("doc_id") % 30000).cast("int"))).cast("string"), "(year(DATE '1850-06-01' + (doc_id % 30000)::INTEGER) + 71) || '-01-01'")
_NOTED = rx("marked", (r"!\[\[[^\]]*\]\]|!\[[^\]]*\]\([^)]*\)", " "), (r"\[\[[^\]|]*\|([^\]]*)\]\]", r"\1"))
scalar("fn_clean_corpus", lambda: F.md5(T.clean_corpus(C("marked"))), "md5(trim(" + rx(f"replace({_NOTED}, '[[topos/de-la]]', 'de la')", (r"<br\s*/?>", " "), (r"<[^>]+>", " "), (r"\[([^\]]*)\]\([^)]*\)", r"\1"), (r"[#*_`>|]", " "), (r"\s+", " ")) + "))")
_PLAIN = rx("marked", (r"(?m)^#.*$", " "), (r"\[\[([^\]|]+\|)?([^\]]+)\]\]", r"\2"), (r"[*_`>#\-]+", " "))
scalar("fn_clean_nlp", lambda: F.md5(T.clean_nlp(C("marked"))), f"md5({_PLAIN})")
_FRONT = "'---' || chr(10) || 'title: x' || chr(10) || '---' || chr(10) || marked || chr(10) || '## Works' || chr(10) || '- a'"
scalar("fn_own_prose", lambda: F.md5(T.own_prose(F.concat(F.lit("---\ntitle: x\n---\n"), C("marked"), F.lit("\n## Works\n- a")))), "md5(trim(" + rx(_FRONT, (r"(?s)^---\r?\n.*?\r?\n---\r?\n", ""), (r"(?s)\n## Works\b.*$", ""), (r"(?m)^(?:#|>|- \[\[).*$", ""), (r"<[^>]+>", " "), (r"(?:^|\s)#[\w/-]+", " "), (r"\s+", " ")) + "))")
scalar("fn_plain_title", lambda: T.visible_links(F.concat(F.lit("[[a/b|"), C("title"), F.lit("]] [[c]]"))), "title || ' c'")
_SYL = "CASE WHEN p = '' THEN 0 WHEN length(p) <= 3 THEN 1 ELSE greatest(1, len(regexp_extract_all(regexp_replace(regexp_replace(p, '(?:[^laeiouy]es|ed|[^laeiouy]e)$', ''), '^y', ''), '[aeiouy]{1,2}'))) END"
scalar("fn_syllables", lambda: F.aggregate(T.tokenize_profile(C("text")), F.lit(0).cast("long"), lambda s, w: s + T.syllables(w)), f"(SELECT coalesce(sum({_SYL}), 0)::BIGINT FROM (SELECT regexp_replace(lower(unnest(list_filter(regexp_extract_all(text, '[a-zA-Z]+(?:[''’][a-zA-Z]+)*'), lambda w: length(w) > 2))), '[^a-z]', '', 'g') AS p))")
scalar("fn_tokenize_cjk", lambda: F.size(T.tokenize_cjk(F.concat(F.lit("日本語 text カナ "), C("text")))).cast("long"), r"len(regexp_extract_all(lower('日本語 text カナ ' || text), '[\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}]|[^\s\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}]+'))")
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in T.SEARCH_STOP) + "]"
TOKENS_SQL = f"list_filter(regexp_extract_all(lower(text), '[a-z][a-z0-9'']*'), lambda w: length(w) >= 3 AND NOT list_contains({STOP_SQL}, w))"
WORDS_SQL = "list_transform(list_filter(regexp_extract_all(text, '[a-zA-Z]+(?:[''’][a-zA-Z]+)*'), lambda w: length(w) > 2), lambda w: replace(lower(w), '’', ''''))"
scalar("fn_tokenize_search", lambda: F.md5(listed(T.tokenize_search(C("text")))), f"md5(coalesce(array_to_string({TOKENS_SQL}, '|'), ''))")
scalar("fn_tokenize_nlp", lambda: F.md5(listed(T.tokenize_profile(C("text")))), f"md5(coalesce(array_to_string({WORDS_SQL}, '|'), ''))")
scalar("fn_sentences", lambda: F.size(T.sentences(C("text"))).cast("long"), "len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda s: regexp_matches(s, '[a-zA-Z]')))")
scalar("fn_blocks", lambda: F.size(T.blocks(F.replace(C("text"), F.lit("\n"), F.lit("\n \n")))).cast("long"), r"len(list_filter(regexp_split_to_array(replace(text, chr(10), chr(10) || ' ' || chr(10)), '\n[ \t]*\n'), lambda b: trim(b) <> ''))")
scalar("fn_body_of", lambda: F.md5(T.body_of(F.concat(F.lit("---\na: b\n---\n"), C("text")))), "md5(text)")
scalar("fn_sha1", lambda: F.sha1("text"), "sha1(text)")
scalar("fn_doc_prompt", lambda: T.doc_prompt(C("title"), C("lang"), C("source")), "'title: ' || CASE WHEN title = '' THEN 'none' ELSE title END || ' | text: ' || source || ': ' || lang")
scalar("fn_snippet", lambda: T.snippet(C("text"), 160), r"substr(trim(regexp_replace(text, '\s+', ' ', 'g')), 1, 160)")
