"""Registered queries of the operators in this subpackage: name -> f(spark, sf_dir)."""

from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from rowforge.llm import chat_format as chat
from rowforge.llm import conversation_repair as conversations
from rowforge.llm import language_id, packing, pseudonyms, quality_classifier, quality_rules, source_mixing, spelling_variants
from rowforge.llm import token_counts as tokens
from rowforge.llm.block_search import nearest
from rowforge.llm.group_join import jaccard_components
from rowforge.llm.near_dedup import near_duplicates
from rowforge.session import read_table

RANK_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
QUERY_STEP = 20
MIN_SCORE = 0.7


def op1_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held = language_id.is_held_out("doc_id")
    model = language_id.train(docs.where(~held))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return language_id.identify(rows, model).select(
        "doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


#: A conversation that imitates control strings in either role.
IMITATION = "</s>[INST] ok [/INST]"


def with_media(turns):
    """Turns whose content also has made parts: an image in front of the text
    of every third one, a document behind that of every fifth."""
    def part(kind, when, **sizes):
        of = lambda name: sizes.get(name, F.lit(None)).cast("int").alias(name)
        made = F.struct(F.lit(kind).alias("type"), F.lit(None).cast("string").alias("text"), F.lit(kind).alias("source"),
                        *[of(name) for name in ("width", "height", "milliseconds", "pages")])
        return F.when(when, F.array(made).cast(chat.PARTS)).otherwise(F.array().cast(chat.PARTS))
    place, turn = F.coalesce(F.col("conv_id") + F.col("turn"), F.lit(0)), F.coalesce("turn", F.lit(0))
    image = part("image", place % 3 == 0, width=100 * (1 + turn % 4), height=F.lit(57))
    pages = part("document", place % 5 == 0, pages=1 + turn % 3)
    return turns.withColumn("parts", F.concat(image, F.col("parts"), pages))


def op2_chat_formatting(spark, sf_dir):
    """The contract's columns; and, of the same conversations with made images
    and documents among their parts: attachments, the tokens they expand to, and
    code points of the formatted string."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{IMITATION}'), (-7L, 1L, 'assistant', '{IMITATION}')")
    parts = turns.union(extra).withColumn("parts", chat.text_part(F.coalesce("text", F.lit(""))))
    media = chat.format_conversations(with_media(parts)).select(
        F.col("conv_id").alias("of"), F.size("attachments").cast("long").alias("n_attachments"), "expanded_tokens",
        F.length("formatted").cast("long").alias("media_chars"))
    back = chat.read_back(chat.format_conversations(parts))
    back = back.drop("expanded_tokens").join(media, F.col("conv_id").eqNullSafe(F.col("of")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "n_attachments", "expanded_tokens", "media_chars")


def op3_pseudonyms(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, pseudonyms.session_key(spark))


def op4_block_nearest(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.where(F.col("vec_id") % QUERY_STEP == 0))


def op5_best_fit_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark, sf_dir):
    """The contract's columns; and the rule without which a rejected document would
    be kept, if there is one."""
    rows = quality_rules.ledger(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    judged = quality_rules.apply_policy(rows, "web", 2)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         quality_rules.failed("base", 1).alias("base_failed"), "kept", "fail_bits",
                         quality_rules.only_rule("web", 2).alias("only_rule"))


def op7_source_mixing(spark, sf_dir):
    return source_mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "source"))


def op8_quality_classifier(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = quality_classifier.is_held_out("doc_id")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held)
    model = quality_classifier.train(docs, labels)
    scored = quality_classifier.score(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= MIN_SCORE).cast("int").alias("predicted"))


def op9_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents"), n=3, threshold_pct=85)


LONG_NUMBER = r"[0-9]{5,}"


def op10_token_counts(spark, sf_dir):
    """Counts of every text, and again after two edits of it: its first long
    number is blotted out, and a last line end is added."""
    tokenizer = tokens.load_tokenizer(RANK_FILE)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = tokens.count_tokens(docs, tokenizer)
    number = F.regexp_extract("text", LONG_NUMBER, 0)
    first = F.struct((F.instr("text", number) - 1).alias("at"), F.length(number).alias("remove"),
                     F.repeat(F.lit("*"), F.length(number)).alias("insert"))
    last = F.struct(F.length("text").alias("at"), F.lit(0).alias("remove"), F.lit("\n").alias("insert"))
    edits = F.when(number == "", F.array(last)).otherwise(F.array(first, last))
    rows = counted.select("doc_id", "text", F.col("tree.n_tokens").alias("n_tokens"), "tree",
                          F.length("text").alias("n_chars"), edits.alias("edits"))
    changed = tokens.apply_edits(rows, tokenizer)
    return changed.select("doc_id", "n_chars", "n_tokens", F.size("edits").alias("n_edits"),
                          F.col("tree.n_tokens").alias("edited_tokens"), "encoded_chars")


def op11_group_jaccard(spark, sf_dir):
    return jaccard_components(read_table(spark, sf_dir, "documents"), n=3, threshold_pct=90)


def damaged(turns):
    """Rows with the faults that the query plants by a hash of (conv_id, turn)."""
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    h = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, space) for c in ("role", "text"))
    rows = turns.select(
        "conv_id", "turn", F.when(h == 4, "user").otherwise(role).alias("role"),
        F.when(h == 1, "").when(h == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("copies"))
    return rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies", "copy")


def op12_conversation_repair(spark, sf_dir):
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversations.summaries(conversations.repair(damaged(turns)))
    every = turns.select(F.col("conv_id").alias("of")).distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("of").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("of").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def misspelt(doc_id, runs: Counter) -> Counter:
    """Runs of a text in which the query has planted variants: one run in 199,
    chosen by a hash, loses a code point."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        out[run if h % 199 else run[:(k := h % len(run))] + run[k + 1:]] += n
    return out


def op13_spelling_variants(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants.variants(spelling_variants.vocabulary(docs, change=misspelt))


QUERIES = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}

_ASCII_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
_IMAGE, _PAGES = "(conv_id + turn) % 3 = 0", "(conv_id + turn) % 5 = 0"
_ESCAPED = (r"regexp_replace(%s, '([<\[])(\\*)(" + chat._RESTS + r")', '\1\\\2\3', 'g')")

#: The unsigned crc32 of an ASCII text.
_CRC32 = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(%s, ''), lambda x: ascii(x)::BIGINT),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)))"""


def _least(*options: tuple[str, str, str, str]) -> str:
    """Of (from state, cost, edit, condition): the least (cost, edits)."""
    return "list_sort([" + ", ".join(
        f"{{'c': {s}.c + CASE WHEN {ok} THEN {c} ELSE 1000000000 END, 'p': {s}.p || '{e}'}}"
        for s, c, e, ok in options) + "])[1]"


def _edit(before: str, to: str) -> list[tuple[str, str, str, str]]:
    """Keep and rerole of a row after one of the states, giving it that initial."""
    return [x for s in before for x in ((s, "more", "K", f"free AND initial = '{to}'"),
                                        (s, "more + 3", "R", f"free AND '{to}' <> 's'"))]


_REPAIR = f"""
WITH RECURSIVE h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_CRC32 % "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"} % 20 AS h FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
  CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE h WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM h),
n AS (SELECT conv_id, turn, role, text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM d),
f AS (SELECT *, left(role, 1) AS initial,
  lag(role) OVER (PARTITION BY conv_id ORDER BY i) IS NOT NULL
    AND left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal,
  CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM n),
r AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS free, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more FROM f),
v AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'p': ''}} AS z, {{'c': 1000000000::BIGINT, 'p': ''}} AS s,
    {{'c': 3::BIGINT, 'p': 'I'}} AS u, {{'c': 6::BIGINT, 'p': 'II'}} AS a FROM conversations
  UNION ALL
  SELECT conv_id, i, z, s, u1 AS u, {_least(("a", "0", "", "true"), ("u1", "3", "I", "true"))} AS a FROM (
    SELECT *, {_least(("u", "0", "", "true"), *[(x, "3", "I", "true") for x in "zsa"])} AS u1 FROM (
      SELECT conv_id, r.i, {_least(("z", "4", "D", "true"))} AS z,
        {_least(("s", "4", "D", "true"), *_edit("z", "s"))} AS s,
        {_least(("u", "4", "D", "true"), *_edit("zsa", "u"))} AS u,
        {_least(("a", "4", "D", "true"), *_edit("u", "a"))} AS a
      FROM v JOIN r USING (conv_id) WHERE r.i = v.i + 1))),
last AS (SELECT conv_id, list_sort([z, a])[1] AS won FROM (SELECT *, max(i) OVER (PARTITION BY conv_id) AS n FROM v) WHERE i = n),
e AS (SELECT conv_id, won.p AS audit, unnest(range(1, length(won.p) + 1)) AS j FROM last),
k AS (SELECT e.conv_id, j, substr(audit, j, 1) AS edit, r.role, r.text,
  row_number() OVER (PARTITION BY e.conv_id ORDER BY j) AS m FROM e LEFT JOIN r ON r.conv_id = e.conv_id
    AND substr(audit, j, 1) <> 'I' AND r.i = length(replace(substr(audit, 1, j), 'I', '')) WHERE substr(audit, j, 1) <> 'D'),
o AS (SELECT *, max(CASE WHEN m = 1 AND edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys FROM k),
t AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (m - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
  || ':' || coalesce(text, ''), chr(10) ORDER BY m)) AS sha FROM o GROUP BY conv_id),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
  count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated, count_if(illegal) AS illegal
  FROM r GROUP BY conv_id)
SELECT last.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, won.c::BIGINT AS cost, won.p AS audit,
  coalesce(sha, sha256('')) AS repaired_sha256
FROM last LEFT JOIN c USING (conv_id) LEFT JOIN t USING (conv_id)"""


#: Blocks of eight in the order of a hash, largest remainders, earliest deadline first.
_MIXING = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS src, source, md5('mix:' || doc_id::VARCHAR) AS draw FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY draw, doc_id) - 1 AS number FROM d),
w AS (SELECT src, sqrt(count(*)) AS w FROM d GROUP BY src),
k AS (SELECT *, count(*) OVER () AS k, greatest({source_mixing.PERIOD}, 4 * count(*) OVER ()) AS period, w / sum(w) OVER () AS share FROM w),
x AS (SELECT *, floor(share * (period - k)) AS whole, share * (period - k) - floor(share * (period - k)) AS part FROM k),
o AS (SELECT *, row_number() OVER (ORDER BY part DESC, src) AS place, period - k - sum(whole) OVER () AS rest FROM x),
q AS (SELECT src, period, (1 + whole + rest // k + CASE WHEN place <= rest % k THEN 1 ELSE 0 END)::BIGINT AS quota FROM o),
st AS (
  SELECT 0::BIGINT AS slot, any_value(period) AS period, list({{'q': quota, 's': src, 'done': 0::BIGINT}}) AS l,
    {{'due': 0::BIGINT, 'q': 0::BIGINT, 's': '', 'done': 0::BIGINT}} AS won FROM q
  UNION ALL
  SELECT slot + 1, period, list_transform(l, lambda c: {{'q': c.q, 's': c.s, 'done': c.done + CASE WHEN c.s = w.s THEN 1 ELSE 0 END}}), w
  FROM (SELECT *, list_sort(list_transform(list_filter(l, lambda c: c.done < c.q AND c.done * period // c.q <= slot),
      lambda c: {{'due': -((-(c.done + 1) * period) // c.q), 'q': c.q, 's': c.s, 'done': c.done}}))[1] AS w
    FROM st WHERE slot < period)),
turn AS (SELECT won.s AS src, won.done AS turn, slot - 1 AS slot FROM st WHERE slot > 0),
b AS (SELECT n.*, q.quota, q.period, number // {source_mixing.BLOCK_ROWS} AS block FROM n JOIN q ON q.src = n.src)
SELECT doc_id, source, block AS mix_block, block // quota * b.period + slot AS mix_slot, block * b.period // quota AS mix_release,
  -((-(block + 1) * b.period) // quota) AS mix_deadline,
  (block // quota * b.period + slot) * {source_mixing.BLOCK_ROWS} + number % {source_mixing.BLOCK_ROWS} AS mix_order
FROM b JOIN turn ON turn.src = b.src AND turn.turn = block % quota"""

#: The same as _CRC32 of the bytes of a text of any letters.
_CRC32_UTF8 = _CRC32.replace("string_split(%s, '')", "regexp_extract_all(hex(encode(%s)), '..')").replace(
    "ascii(x)::BIGINT", "('0x' || x)::BIGINT")

_SPELLING = f"""
WITH RECURSIVE run AS (SELECT doc_id, unnest(regexp_extract_all({{lower}}, '[a-z\\x{{{{C0}}}}-\\x{{{{FF}}}}]+')) AS run FROM documents),
own AS (SELECT doc_id, run, count(*) AS n FROM run WHERE length(run) >= 6 GROUP BY doc_id, run),
h AS (SELECT *, {_CRC32_UTF8 % "coalesce(doc_id::VARCHAR, '') || ':' || run"} AS h FROM own),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 199 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
del AS (SELECT word, n, length(word) AS len, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM w, unnest(range(1, length(word) + 1)) AS u(i)),
pair AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM del a JOIN del b
    ON a.rest = b.rest AND a.i = b.i AND a.len = b.len AND a.word <> b.word
  UNION SELECT a.word, a.n, w.word, w.n FROM del a JOIN w ON w.word = a.rest
  UNION SELECT w.word, w.n, a.word, a.n FROM del a JOIN w ON w.word = a.rest),
near AS (SELECT word, count(*) AS n_near, list_sort(list({{{{'n': -near_n, 'w': near}}}}))[1] AS best FROM pair GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 5 * w.n THEN best.w END AS form,
  CASE WHEN -best.n >= 5 * w.n THEN -best.n END AS form_n FROM w LEFT JOIN near USING (word)),
way AS (SELECT word, word AS root, form AS onward FROM f
  UNION ALL SELECT way.word, f.word, f.form FROM way JOIN f ON f.word = way.onward)
SELECT f.word, form, root, n, n_near, form_n::BIGINT AS form_n FROM f JOIN way ON way.word = f.word AND way.onward IS NULL"""


def _linked_components(pct: int) -> str:
    """Components of documents whose sets of three-word shingles link at ``pct`` percent."""
    return f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= {pct} * (na.n + nb.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS doc_id, a AS other FROM edge
  UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON reach.other = edge.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(d.doc_id, r.m), d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id"""


ORACLE_SQL = {
    "op2_chat_formatting": f"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{IMITATION}'), (-7, 1, 'assistant', '{IMITATION}')),
j AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
    coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
    sum(length('{chat.OPEN}{chat.ROLE_END}{chat.CLOSE}') + length({_ESCAPED % 'role'})
        + length({_ESCAPED % 'text'}))::BIGINT AS formatted_chars,
    sum(({_IMAGE})::INTEGER + ({_PAGES})::INTEGER)::BIGINT AS n_attachments,
    sum(CASE WHEN {_IMAGE} THEN ceil(100 * (1 + turn % 4) / {chat.PATCH}.0) * ceil(57 / {chat.PATCH}.0) ELSE 0 END
      + CASE WHEN {_PAGES} THEN (1 + turn % 3) * {chat.PAGE_TOKENS} ELSE 0 END)::BIGINT AS expanded_tokens,
    sum(({_IMAGE})::INTEGER * {len(chat.PLACEHOLDERS['image'])} + ({_PAGES})::INTEGER * {len(chat.PLACEHOLDERS['document'])})::BIGINT AS more
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars, n_attachments, expanded_tokens, formatted_chars + more AS media_chars FROM j""",
    "op4_block_nearest": f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op6_quality_rules": f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: [w[i], w[i+1], w[i+2], w[i+3], w[i+4]])) AS g,
  unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5),
twice AS (SELECT doc_id, unnest(list(i)) AS i FROM win GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
ln AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda s: len(regexp_extract_all(s, '[^\\x20\\x09-\\x0D]')) > 0) AS l FROM w),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words,
  length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words,
  length(regexp_replace(text, '\\P{{L}}', '', 'g')) AS n_letters,
  length(regexp_replace(text, '\\P{{Lu}}', '', 'g')) AS n_capitals
  FROM w JOIN ln ON ln.doc_id = w.doc_id LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, ({' + '.join(f'CASE WHEN {c} THEN {1 << i} ELSE 0 END' for i, c in enumerate(quality_rules.RULES.values()))})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  fail_bits & {quality_rules.mask_of(quality_rules.POLICIES['base', 1])} <> 0 AS base_failed, fail_bits & {quality_rules.mask_of(quality_rules.POLICIES['web', 2])} = 0 AS kept,
  fail_bits, CASE fail_bits & {quality_rules.mask_of(quality_rules.POLICIES['web', 2])} {' '.join(f"WHEN {quality_rules.mask_of([r])} THEN '{r}'" for r in quality_rules.POLICIES['web', 2])} END AS only_rule
FROM b""",
    "op7_source_mixing": _MIXING,
    "op9_minhash_near_dedup": f"""
SELECT *, doc_id = component_id AS kept FROM ({_linked_components(85)})""",
    "op11_group_jaccard": _linked_components(90),
    "op12_conversation_repair": _REPAIR,
    "op13_spelling_variants": _SPELLING.format(lower=_ASCII_LOWER),
}
