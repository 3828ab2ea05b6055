"""The same queries as SQL over the test tables, without the library's ways of doing it."""

from __future__ import annotations

import hashlib

from catalog.queries import (
    ACCUMULATION,
    BLOCK,
    CAP,
    EPOCHS,
    FLATTEN,
    LIMIT_STEP,
    MAX_LEN,
    PER_CATEGORY,
    PER_DEVICE,
    SEED,
    SUBSET,
    SYSTEM,
    WORLD,
)

# The white space of Unicode, as text is stripped of it.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WORDS = r"'[^ \t\n\r\f]+'"

RECORDS = """
t AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER w AS nrole, lead(text) OVER w AS ntext,
         lag(role)  OVER w AS prole, lag(text)  OVER w AS ptext
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
records AS (
  SELECT concat('C', t.conv_id, '-', t.turn) AS id,
         t.text AS instruction,
         CASE WHEN prole = 'system' THEN ptext ELSE '' END AS input,
         CASE WHEN nrole = 'assistant' THEN ntext END AS output,
         d.lang AS language,
         CASE WHEN t.conv_id % 11 = 0 OR d.lang IS NULL THEN NULL
              ELSE concat(upper(d.lang), '-', CASE WHEN t.conv_id % 3 = 0 THEN 'Code' ELSE 'General' END)
         END AS category,
         d.source AS topic,
         CASE WHEN l.quality = 1 THEN 'Advanced' WHEN l.quality = 0 THEN 'Basic' ELSE 'Unrated' END AS difficulty,
         t.conv_id, t.turn
  FROM t LEFT JOIN documents d ON d.doc_id = t.conv_id
         LEFT JOIN labels l ON l.doc_id = t.conv_id
  WHERE t.role = 'user')"""

COMPLETE = f"""{RECORDS},
stripped AS (
  SELECT * REPLACE (trim(instruction, '{WHITESPACE}') AS instruction,
                    trim(input, '{WHITESPACE}') AS input,
                    trim(coalesce(output, ''), '{WHITESPACE}') AS output)
  FROM records),
complete AS (
  SELECT *, CASE WHEN input = '' THEN instruction
                 ELSE concat(instruction, chr(10), chr(10), input) END AS user_text
  FROM stripped WHERE instruction <> '' AND output <> '')"""

RENDERED = f"""{COMPLETE},
rendered AS (
  SELECT *, concat('<|im_start|>system', chr(10), '{SYSTEM}', '<|im_end|>', chr(10),
                   '<|im_start|>user', chr(10), user_text, '<|im_end|>', chr(10),
                   '<|im_start|>assistant', chr(10), output, '<|im_end|>', chr(10)) AS text
  FROM complete)"""

# Words of the rendered text, and its place in the seeded order.
ORDERED = f"""{RENDERED},
counted AS (
  SELECT *, regexp_extract_all(text, {WORDS}) AS words,
         row_number() OVER (ORDER BY md5(concat('{SEED}:', id)), id) - 1 AS pos
  FROM rendered),
sized AS (SELECT *, len(words)::BIGINT AS n FROM counted),
placed AS (
  SELECT *, (sum(n) OVER (ORDER BY pos) - n)::BIGINT AS off FROM sized),
pieces AS (
  SELECT id, pos, n, off, words, unnest(range(off // {BLOCK}, (off + n - 1) // {BLOCK} + 1)) AS block_id
  FROM placed WHERE n > 0),
cut AS (
  SELECT *, greatest(block_id * {BLOCK} - off, 0) AS start,
         greatest(off - block_id * {BLOCK}, 0) AS place,
         least(block_id * {BLOCK} + {BLOCK} - off, n) - greatest(block_id * {BLOCK} - off, 0) AS length
  FROM pieces)"""


def piece_id(piece: str) -> str:
    return f"CAST('0x' || substr(md5({piece}), 1, 7) AS INT)"


def ranked(source: str, where: str = "true") -> str:
    return f"""
ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5(concat('{SEED}:', id)), id) - 1 AS pos
  FROM {source} WHERE {where})"""


def n_val(fraction: float = 0.02, n: str = "count(*)") -> str:
    return f"greatest(1, trunc({n} * {fraction}::DOUBLE)::BIGINT)"


# The words of the rendered text of both splits, in pieces of four characters.
PIECES = f"""{RENDERED},{ranked('rendered')},
labelled AS (
  SELECT text, CASE WHEN pos < (SELECT {n_val()} FROM ranked) THEN 'validation' ELSE 'train' END AS split FROM ranked),
ordered AS (
  SELECT split, regexp_extract_all(text, {WORDS}) AS words,
         row_number() OVER (PARTITION BY split ORDER BY md5(concat('{SEED}:', text)), md5(text)) - 1 AS p
  FROM labelled),
each_word AS (SELECT split, p, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM ordered),
chopped AS (SELECT split, p, k, word, unnest(range(0, len(word), 4)) AS c FROM each_word),
pieces_of AS (SELECT split, p, k, c, {piece_id('substr(word, c + 1, 4)')} AS piece_id FROM chopped)"""


def template_text(form: str, system: bool) -> str:
    """What a conversation of one question and one answer looks like."""
    said = f"'{SYSTEM}'" if system else "'You are a helpful assistant.'"
    if form == "chatml_assistant":
        turns = (("'system'", said), ("'user'", "user_text"), ("'assistant'", "output"))
        return "concat(" + ", ".join(f"'<|im_start|>', {r}, chr(10), {c}, '<|im_end|>', chr(10)" for r, c in turns) + ")"
    if form == "inst":
        folded = f"'<<SYS>>', chr(10), '{SYSTEM}', chr(10), '<</SYS>>', chr(10), chr(10), " if system else ""
        return f"concat('<s>[INST] ', {folded}user_text, ' [/INST] ', output, ' </s>')"
    folded = f"'{SYSTEM}', chr(10), chr(10), " if system else ""
    return f"""concat('<bos><start_of_turn>user', chr(10), {folded}user_text, '<end_of_turn>', chr(10),
                   '<start_of_turn>model', chr(10), output, '<end_of_turn>', chr(10))"""


TEMPLATES = " UNION ALL ".join(
    f"SELECT id, {str(system).lower()} AS system, '{form}' AS form, {template_text(form, system)} AS text FROM complete"
    for system in (True, False)
    for form in ("chatml_assistant", "inst", "turns")
)


def mixing_step(x: str, key: str) -> str:
    word = 1 << 31
    return f"xor({x} % {word} + ({x} >> 31), {key}) % {word} * 1103515245 % {word} * 739982445 % {word - 1}"


def epoch_steps(epochs: int, seed: int = SEED, rounds: int = 6) -> str:
    """All places of the grid sent on by the rounds, then walked until they lie inside."""
    columns = [f"k{i}" for i in range(2 * rounds)]
    keys = ", ".join(
        f"({e}, " + ", ".join(str(int(hashlib.md5(f"{seed}:{e}:{i}".encode()).hexdigest()[:8], 16) % (1 << 31)) for i in range(2 * rounds)) + ")"
        for e in range(epochs)
    )
    steps = [f"""n_of AS (SELECT count(*) AS n FROM placed_ids),
sides AS (SELECT n, least(floor(sqrt(n - 1))::BIGINT + 1, 1024) AS a FROM n_of),
grid AS (SELECT n, a, (n + a - 1) // a AS b FROM sides),
keys(epoch, {", ".join(columns)}) AS (VALUES {keys}),
f0 AS (
  SELECT epoch, n, a, b, place, place % a AS l, place // a AS r, {", ".join(columns)}
  FROM (SELECT *, unnest(range(a * b)) AS place FROM grid), keys)"""]
    for i in range(rounds):
        steps.append(f"h{i} AS (SELECT * REPLACE ((l + {mixing_step('r', f'k{2 * i}')}) % a AS l) FROM f{i})")
        steps.append(f"f{i + 1} AS (SELECT * REPLACE ((r + {mixing_step('l', f'k{2 * i + 1}')}) % b AS r) FROM h{i})")
    steps.append(f"sent AS (SELECT epoch, n, place, r * a + l AS goal FROM f{rounds})")
    steps.append("""walk AS (
  SELECT epoch, n, place, goal FROM sent WHERE place < n
  UNION ALL
  SELECT w.epoch, w.n, w.place, s.goal FROM walk w JOIN sent s ON s.epoch = w.epoch AND s.place = w.goal WHERE w.goal >= w.n)""")
    steps.append("arrived AS (SELECT epoch, n, place AS pos, goal FROM walk WHERE goal < n)")
    return ", ".join(steps)


EPOCH_ORDER = f"""{RECORDS},{ranked('records')},
placed_ids AS (SELECT id, pos FROM ranked)"""

# The damage rule of the lines, applied to the records they come from.
CUT, TRAILING, WRAPPED = "conv_id % 13 = 0", "conv_id % 17 = 0", "conv_id % 19 = 0"
GOOD = f"NOT ({CUT} OR {TRAILING} OR {WRAPPED})"
REASON = f"CASE WHEN {CUT} OR {TRAILING} THEN 'malformed' WHEN {WRAPPED} THEN 'not_object' END"
WANTED = "lower(coalesce(category, '')) IN ('en-code', 'fr-general')"
DONE = "instruction <> '' AND output <> ''"

SPLIT = f"""{COMPLETE},{ranked('complete')},
split AS (
  SELECT *, CASE WHEN pos < (SELECT {n_val()} FROM ranked) THEN 'val' ELSE 'train' END AS split
  FROM ranked)"""

LOADED = f"""{COMPLETE},
loaded AS (SELECT * FROM stripped WHERE {GOOD})"""


def prepared(where: str = "true", cap: int | None = None, fraction: float = 0.02) -> str:
    limit = "true" if cap is None else f"pos < {cap}"
    return f"""{LOADED},{ranked('loaded', where)},
capped AS (SELECT * FROM ranked WHERE {limit}),
prepared AS (
  SELECT *, CASE WHEN pos < (SELECT {n_val(fraction)} FROM capped) THEN 'val' ELSE 'train' END AS split,
         {DONE} AS written
  FROM capped)"""


def counters(where: str, cap: int | None, fraction: float) -> str:
    return f"""WITH {prepared(where, cap, fraction)}
SELECT (SELECT count(*) FROM loaded)::BIGINT AS loaded,
       (SELECT count(*) FROM records WHERE {REASON} = 'malformed')::BIGINT AS malformed,
       (SELECT count(*) FROM records WHERE {REASON} = 'not_object')::BIGINT AS unusable,
       (SELECT count(*) FROM loaded WHERE {where})::BIGINT AS kept,
       count(*) FILTER (written AND split = 'train')::BIGINT AS train,
       count(*) FILTER (written AND split = 'val')::BIGINT AS val,
       count(*) FILTER (NOT written)::BIGINT AS skipped
FROM prepared"""


PROMPTS = """
prompts AS (
  SELECT item_id AS ord, concat('p', item_id) AS id, concat('cat', item_id % 7) AS category, text AS prompt
  FROM benchmark)"""

RESULTS = f"""{PROMPTS},
answers AS (
  SELECT r.run, p.id, d.text AS response
  FROM prompts p CROSS JOIN (SELECT 'a' AS run UNION ALL SELECT 'b') r
  JOIN documents d ON d.doc_id = p.ord + CASE WHEN r.run = 'b' AND p.ord % 3 = 0 THEN 1 ELSE 0 END
  WHERE NOT (r.run = 'a' AND p.ord % 10 = 1) AND NOT (r.run = 'b' AND p.ord % 10 = 2)),
results AS (
  SELECT a.run, p.ord, p.id, p.category, p.prompt, a.response,
         len(regexp_extract_all(concat(
           '<|im_start|>system', chr(10), '{SYSTEM}', '<|im_end|>', chr(10), '<|im_start|>user', chr(10),
           p.prompt, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10)), {WORDS}))::BIGINT AS prompt_tokens,
         len(regexp_extract_all(a.response, {WORDS}))::BIGINT AS completion_tokens
  FROM prompts p LEFT JOIN answers a ON a.id = p.id),
sections AS (
  SELECT run, ord, concat('## [', category, '] ', id, chr(10), chr(10), '**Prompt:** ', prompt, chr(10), chr(10),
    '**Response:**', chr(10), chr(10), response, chr(10), chr(10), '*(', prompt_tokens, ' prompt tokens, ',
    completion_tokens, ' completion tokens)*', chr(10), chr(10), '---', chr(10)) AS section
  FROM results WHERE response IS NOT NULL)"""

# Lines and characters the header of a run's report adds.
# The head of a report: title, "model a" and the time with its zone, a rule, and blank lines between.
HEADER_LINES = 8
HEADER_CHARS = len("# Eval Report") + len("**Model:** model a") + len("**Generated:** 2024-01-02T03:04:05+00:00") + len("---")

MESSAGES_OF = """
SELECT id, 0 AS idx, 'system' AS role, '{system}' AS content FROM {table}
UNION ALL SELECT id, 1, 'user', {user} FROM {table}"""

BATCH = PER_DEVICE * ACCUMULATION * WORLD

def limits(step: int, batch: int, by: str = "lang") -> str:
    """What every limit costs, by adding up all documents for each."""
    steps = f"ceil({EPOCHS}::DOUBLE * {{}} / {batch})::BIGINT"
    blocks = "((total + max_seq_length - 1) // max_seq_length)"
    group = "c.grp AS lang, " if by == "lang" else ""
    return f"""WITH w AS (SELECT {by} AS grp, len(regexp_extract_all(text, {WORDS}))::BIGINT AS n FROM documents),
g AS (SELECT grp, count(*) AS n_rows, sum(n)::BIGINT AS total, max(n) AS longest FROM w GROUP BY grp),
h AS (SELECT grp, n, count(*) AS n_rows FROM w GROUP BY grp, n),
l AS (SELECT grp, unnest(range({step}, longest + {step}, {step}))::BIGINT AS max_seq_length FROM g WHERE longest > 0),
c AS (SELECT l.grp, max_seq_length, sum(CASE WHEN h.n > max_seq_length THEN h.n_rows ELSE 0 END)::BIGINT AS n_cut,
             sum(h.n_rows * least(h.n, max_seq_length))::BIGINT AS kept_tokens
      FROM l JOIN h ON h.grp IS NOT DISTINCT FROM l.grp GROUP BY 1, 2)
SELECT {group}max_seq_length, g.n_rows::BIGINT AS n, n_cut, round(n_cut::DOUBLE / g.n_rows, 6)::DOUBLE AS share_cut,
       kept_tokens, (total - kept_tokens)::BIGINT AS lost_tokens,
       (g.n_rows * max_seq_length - kept_tokens)::BIGINT AS padding_tokens,
       {steps.format("g.n_rows")} AS steps, {blocks}::BIGINT AS packed_blocks, {steps.format(blocks)} AS packed_steps
FROM c JOIN g ON g.grp IS NOT DISTINCT FROM c.grp"""


ORACLE: dict[str, str] = {
    "parse_lines": f"""WITH {LOADED}
SELECT id, instruction, output, difficulty FROM loaded""",
    "quarantine_reasons": f"""WITH {RECORDS}
SELECT {REASON} AS reason, count(*)::BIGINT AS n FROM records WHERE {REASON} IS NOT NULL GROUP BY 1""",
    "sniff_shape": f"""WITH {RECORDS},
head AS (
  SELECT conv_id % 5 AS file, {REASON} IS NULL AND output IS NOT NULL AS ok,
         row_number() OVER (PARTITION BY conv_id % 5 ORDER BY conv_id, turn) AS rn
  FROM records)
SELECT file, bool_and(ok) AS ok FROM head WHERE rn <= 3 GROUP BY file""",
    "discover_sources": f"""WITH {COMPLETE}
SELECT 'records' AS folder, true AS valid, count(*)::BIGINT AS n FROM complete
UNION ALL SELECT 'prompts', false, count(*)::BIGINT FROM benchmark""",
    "resolve_split": f"""WITH {SPLIT}
SELECT 'train' AS split, count(*)::BIGINT AS n, (3 * count(*))::BIGINT AS n_msgs FROM split WHERE split = 'train'""",
    "read_chat": f"""WITH {SPLIT}
SELECT CASE split WHEN 'val' THEN 'validation' ELSE split END AS split,
       count(*)::BIGINT AS n, (3 * count(*))::BIGINT AS n_msgs FROM split GROUP BY 1""",
    "read_prompts": f"""WITH {PROMPTS} SELECT row_number() OVER (ORDER BY ord) - 1 AS ord, id, category, prompt FROM prompts""",
    "require_fields": f"""WITH {COMPLETE} SELECT id, instruction, input, output FROM complete""",
    "filter_category": f"""WITH {RECORDS} SELECT id, category FROM records WHERE {WANTED}""",
    "compose_user": f"""WITH {COMPLETE} SELECT id, user_text AS content FROM complete""",
    "to_messages": f"""WITH {COMPLETE}
{MESSAGES_OF.format(system=SYSTEM, table='complete', user='user_text')}
UNION ALL SELECT id, 2, 'assistant', output FROM complete""",
    "to_messages_no_system": f"""WITH {COMPLETE}
SELECT id, 0 AS idx, 'user' AS role, user_text AS content FROM complete
UNION ALL SELECT id, 1, 'assistant', output FROM complete""",
    "prompt_messages": f"""WITH {PROMPTS}
{MESSAGES_OF.format(system=SYSTEM, table='prompts', user='prompt')}""",
    "render_chat": f"""WITH {RENDERED} SELECT id, text FROM rendered""",
    "render_prompt": f"""WITH {PROMPTS}
SELECT id, concat('<|im_start|>system', chr(10), '{SYSTEM}', '<|im_end|>', chr(10), '<|im_start|>user', chr(10),
  prompt, '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10)) AS text FROM prompts""",
    "select_text": f"""WITH {RENDERED},{ranked('rendered')}
SELECT CASE WHEN pos < (SELECT {n_val()} FROM ranked) THEN 'val' ELSE 'train' END AS split, pos, text FROM ranked""",
    "truncate_tokens": f"""WITH w AS (SELECT doc_id, regexp_extract_all(text, {WORDS}) AS words FROM documents)
SELECT doc_id, len(words)::BIGINT AS n, least(len(words), {MAX_LEN})::BIGINT AS n_kept,
       greatest(len(words) - {MAX_LEN}, 0)::BIGINT AS n_dropped,
       md5(array_to_string(words[1:{MAX_LEN}], ' ')) AS kept_md5
FROM w""",
    "estimate_tokens": f"""SELECT doc_id, len(regexp_extract_all(text, {WORDS}))::BIGINT AS n_tokens FROM documents""",
    "token_counter_hook": f"""SELECT doc_id, len(regexp_extract_all(text, {WORDS}))::BIGINT AS n_tokens FROM documents""",
    "seeded_order": f"""WITH {RECORDS},{ranked('records')} SELECT id, pos FROM ranked""",
    **{
        name: f"""WITH {RECORDS},
named AS (
  SELECT CASE conv_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'same' ELSE concat(conv_id, '-', turn) END AS id,
         concat(conv_id, '-', turn) AS name
  FROM records)
SELECT id, name, row_number() OVER (
         ORDER BY md5(concat('{SEED}:', coalesce(id, md5(name)))), md5(concat('{SEED}:', md5(name)))) - 1 AS pos
FROM named"""
        for name in ("seeded_order_no_id", "seeded_order_hot")
    },
    "cap_examples": f"""WITH {RECORDS},{ranked('records')} SELECT id, pos FROM ranked WHERE pos < {CAP}""",
    "split_train_val": f"""WITH {RECORDS},{ranked('records')}
SELECT id, pos, CASE WHEN pos < (SELECT {n_val()} FROM ranked) THEN 'val' ELSE 'train' END AS split FROM ranked""",
    "assign_shards": f"""WITH {ORDERED}
SELECT (pos % {WORLD})::INT AS rank, count(*)::BIGINT AS n, sum(n)::BIGINT AS tokens FROM sized GROUP BY 1""",
    "category_distribution": f"""WITH {RECORDS}
SELECT coalesce(category, 'unknown') AS category, count(*)::BIGINT AS n FROM records GROUP BY 1""",
    "top_categories": """SELECT concat(source, '-', lang) AS category, count(*)::BIGINT AS n
FROM documents GROUP BY 1 ORDER BY n DESC, category LIMIT 10""",
    "run_counters": counters("true", None, 0.02),
    "run_counters_filtered": counters(WANTED, CAP, 0.1),
    "prepared_records": f"""WITH {prepared()}
SELECT id, pos, split, written,
       CASE WHEN input = '' THEN instruction ELSE concat(instruction, chr(10), chr(10), input) END AS user
FROM prepared""",
    "prepared_categories": f"""WITH {prepared()}
SELECT coalesce(category, 'unknown') AS category, count(*)::BIGINT AS n FROM prepared GROUP BY 1""",
    "token_length_profile": f"""WITH w AS (
  SELECT lang, len(regexp_extract_all(text, {WORDS}))::BIGINT AS n FROM documents)
SELECT lang, count(*)::BIGINT AS n, round(quantile_cont(n, 0.5), 4)::DOUBLE AS p50,
       round(quantile_cont(n, 0.9), 4)::DOUBLE AS p90, round(avg(n), 4)::DOUBLE AS mean,
       max(n)::BIGINT AS max, count(*) FILTER (n > {MAX_LEN})::BIGINT AS over
FROM w GROUP BY lang""",
    "balance_categories": f"""WITH {RECORDS},{ranked('records')},
labelled AS (SELECT id, coalesce(category, 'unknown') AS category, pos FROM ranked),
sizes AS (SELECT category, count(*) AS n_k FROM labelled GROUP BY 1),
numbered AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY pos) AS rn FROM labelled)
SELECT id, category, round((SELECT count(*) FROM labelled)::DOUBLE / ((SELECT count(*) FROM sizes) * n_k), 4)::DOUBLE AS weight
FROM numbered JOIN sizes USING (category) WHERE rn <= {PER_CATEGORY}""",
    "run_sizing": f"""WITH {RECORDS},{ranked('records')},
split AS (SELECT CASE WHEN pos < (SELECT {n_val()} FROM ranked) THEN 'val' ELSE 'train' END AS split FROM ranked)
SELECT split, count(*)::BIGINT AS n, {BATCH}::BIGINT AS effective_batch,
       ceil({EPOCHS}::DOUBLE * count(*) / {BATCH})::BIGINT AS steps
FROM split GROUP BY split""",
    "conversation_usage": f"""WITH said AS (
  SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN trim(text, '{WHITESPACE}') ELSE text END AS text
  FROM conversations),
open AS (
  SELECT s.*, len(regexp_extract_all(text, {WORDS}))::BIGINT AS n FROM said s
  WHERE NOT EXISTS (SELECT 1 FROM said e WHERE e.conv_id = s.conv_id AND e.turn <= s.turn
                    AND e.role = 'user' AND lower(e.text) IN ('exit', 'quit'))),
hist AS (SELECT *, (sum(n) OVER (PARTITION BY conv_id ORDER BY turn) - n)::BIGINT AS p FROM open)
SELECT conv_id, turn, p AS prompt_tokens, n AS completion_tokens, (p + n)::BIGINT AS turn_total,
       (sum(p + n) OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT AS session_total
FROM hist WHERE role = 'assistant'""",
    "pack_sequences": f"""WITH {ORDERED}
SELECT block_id::BIGINT AS block_id, id, start::BIGINT AS start, place::BIGINT AS place, length::BIGINT AS length FROM cut""",
    "pack_by_position": f"""WITH {ORDERED}
SELECT block_id::BIGINT AS block_id, id, start::BIGINT AS start, place::BIGINT AS place, length::BIGINT AS length FROM cut""",
    "packed_blocks": f"""WITH {ORDERED},
filled AS (SELECT block_id, place, words[start + 1 : start + length] AS part FROM cut)
SELECT block_id::BIGINT AS block_id, count(*)::BIGINT AS n_segments, sum(len(part))::BIGINT AS n_tokens,
       md5(string_agg(array_to_string(part, ' '), ' ' ORDER BY place)) AS tokens_md5
FROM filled GROUP BY block_id""",
    "packing_report": f"""WITH {ORDERED}
SELECT count(*)::BIGINT AS n, sum(n)::BIGINT AS tokens, ceil(sum(n) / {BLOCK})::BIGINT AS blocks,
       (count(*) * {BLOCK} - sum(least(n, {BLOCK})))::BIGINT AS padding_unpacked,
       (ceil(sum(n) / {BLOCK})::BIGINT * {BLOCK} - sum(n))::BIGINT AS padding_packed
FROM sized WHERE n > 0""",
    "training_shards": f"""WITH {RENDERED},{ranked('rendered')},
train AS (
  SELECT text, row_number() OVER (ORDER BY md5(concat('{SEED}:', text)), md5(text)) - 1 AS p
  FROM ranked WHERE pos >= (SELECT {n_val()} FROM ranked))
SELECT (p % {WORLD})::INT AS rank, p AS pos, text,
       len(regexp_extract_all(text, {WORDS}))::BIGINT AS n_tokens FROM train""",
    "training_blocks": f"""WITH {RENDERED},{ranked('rendered')},
labelled AS (
  SELECT text, CASE WHEN pos < (SELECT {n_val()} FROM ranked) THEN 'validation' ELSE 'train' END AS split FROM ranked),
ordered AS (
  SELECT split, regexp_extract_all(text, {WORDS}) AS words,
         row_number() OVER (PARTITION BY split ORDER BY md5(concat('{SEED}:', text)), md5(text)) AS p
  FROM labelled),
each_word AS (SELECT split, p, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM ordered),
laid AS (
  SELECT split, p, word, row_number() OVER (PARTITION BY split ORDER BY p, k) - 1 AS slot FROM each_word)
SELECT split, (slot // {BLOCK})::BIGINT AS block_id, count(DISTINCT p)::BIGINT AS n_segments,
       md5(string_agg(word, ' ' ORDER BY slot)) AS tokens_md5
FROM laid GROUP BY split, slot // {BLOCK}""",
    "training_block_ids": f"""WITH {PIECES},
laid AS (
  SELECT split, p, piece_id, row_number() OVER (PARTITION BY split ORDER BY p, k, c) - 1 AS slot FROM pieces_of),
placed_ids AS (
  SELECT *, slot // {BLOCK} AS b, row_number() OVER (PARTITION BY split, p, slot // {BLOCK} ORDER BY slot) - 1 AS own FROM laid)
SELECT split, b::BIGINT AS block_id, count(DISTINCT p)::BIGINT AS n_segments,
       md5(string_agg(piece_id::VARCHAR, ' ' ORDER BY slot)) AS ids_md5, md5(string_agg(own::VARCHAR, ' ' ORDER BY slot)) AS places_md5
FROM placed_ids GROUP BY split, b""",
    "block_segments": f"""WITH {PIECES}
SELECT split, p::BIGINT AS pos, count(*)::BIGINT AS n_tokens, md5(string_agg(piece_id::VARCHAR, ' ' ORDER BY k, c)) AS ids_md5
FROM pieces_of GROUP BY split, p""",
    "truncate_ids": f"""WITH matches AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[ \\t\\n\\r\\f]*[^ \\t\\n\\r\\f]+') AS found FROM documents),
each_match AS (SELECT doc_id, unnest(found) AS m, generate_subscripts(found, 1) AS k FROM matches),
words_of AS (
  SELECT doc_id, k, regexp_extract(m, {WORDS}) AS word, sum(length(m)) OVER (PARTITION BY doc_id ORDER BY k) AS word_end FROM each_match),
chopped AS (SELECT *, unnest(range(0, length(word), 4)) AS c FROM words_of),
each_piece AS (
  SELECT doc_id, {piece_id('substr(word, c + 1, 4)')} AS piece_id, word_end - length(word) + least(c + 4, length(word)) AS piece_end,
         row_number() OVER (PARTITION BY doc_id ORDER BY k, c) AS slot FROM chopped),
summed AS (
  SELECT doc_id, count(*) AS n, max(piece_end) FILTER (slot <= {MAX_LEN}) AS text_end,
         md5(string_agg(piece_id::VARCHAR, ' ' ORDER BY slot) FILTER (slot <= {MAX_LEN})) AS ids_md5
  FROM each_piece GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n, least(coalesce(n, 0), {MAX_LEN})::BIGINT AS n_kept,
       greatest(coalesce(n, 0) - {MAX_LEN}, 0)::BIGINT AS n_dropped, coalesce(text_end, 0)::BIGINT AS text_end,
       coalesce(ids_md5, md5('')) AS ids_md5
FROM documents d LEFT JOIN summed USING (doc_id)""",
    "render_templates": f"""WITH {COMPLETE} {TEMPLATES}""",
    "epoch_shards": f"""WITH RECURSIVE {EPOCH_ORDER}, {epoch_steps(EPOCHS)},
filled AS (SELECT *, unnest(range(goal, (n + {WORLD} - 1) // {WORLD} * {WORLD}, n)) AS slot FROM arrived)
SELECT epoch::INT AS epoch, (slot % {WORLD})::INT AS rank, slot // {WORLD} AS step, pos, id FROM filled JOIN placed_ids USING (pos)""",
    "epoch_shards_dropped": f"""WITH RECURSIVE {EPOCH_ORDER}, {epoch_steps(1)}
SELECT (goal % {WORLD})::INT AS rank, count(*)::BIGINT AS n, count(DISTINCT pos)::BIGINT AS n_pos, max(goal // {WORLD})::BIGINT AS last_step
FROM arrived WHERE goal < n // {WORLD} * {WORLD} GROUP BY 1""",
    "weighted_subset": f"""WITH {COMPLETE},
weighed AS (SELECT id, category, len(regexp_extract_all(output, {WORDS}))::BIGINT AS weight FROM complete),
sizes AS (SELECT category, count(*) AS available FROM weighed WHERE weight > 0 GROUP BY category),
shares AS (SELECT category, {SUBSET} * pow(available, {FLATTEN}) / sum(pow(available, {FLATTEN})) OVER () AS part FROM sizes),
quotas AS (
  SELECT category, floor(part) + CASE WHEN row_number() OVER (ORDER BY part - floor(part) DESC, category NULLS FIRST)
                                           <= {SUBSET} - sum(floor(part)) OVER () THEN 1 ELSE 0 END AS quota FROM shares),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY category
    ORDER BY -ln((CAST('0x' || substr(md5(concat('{SEED}:', id)), 1, 13) AS BIGINT) + 0.5) / 4503599627370496) / weight) AS r
  FROM weighed WHERE weight > 0)
SELECT id, r.category, weight FROM ranked r JOIN quotas q ON q.category IS NOT DISTINCT FROM r.category WHERE r <= quota""",
    "eval_results": f"""WITH {RESULTS}
SELECT run, id, category, prompt_tokens, completion_tokens FROM results""",
    "eval_report": f"""WITH {RESULTS} SELECT run, ord, section FROM sections""",
    "compare_runs": f"""WITH {RESULTS},
a AS (SELECT * FROM results WHERE run = 'a'), b AS (SELECT * FROM results WHERE run = 'b')
SELECT coalesce(a.id, b.id) AS id,
       CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed'
            WHEN a.response = b.response THEN 'same' ELSE 'changed' END AS status,
       b.completion_tokens - a.completion_tokens AS delta_tokens
FROM a FULL OUTER JOIN b ON a.id = b.id""",
    "length_limits": limits(1, PER_DEVICE * ACCUMULATION * WORLD),
    "length_limits_stepped": limits(LIMIT_STEP, PER_DEVICE * ACCUMULATION, "0"),
    "answer_changes_rebuilt": f"""WITH {RESULTS},
a AS (SELECT * FROM answers WHERE run = 'a'), b AS (SELECT * FROM answers WHERE run = 'b')
SELECT coalesce(a.id, b.id) AS id,
       md5(coalesce(array_to_string(regexp_extract_all(a.response, {WORDS}), ' '), '')) AS before_md5,
       md5(coalesce(array_to_string(regexp_extract_all(b.response, {WORDS}), ' '), '')) AS after_md5
FROM a FULL OUTER JOIN b ON a.id = b.id
WHERE coalesce(len(regexp_extract_all(a.response, {WORDS})), 0) + coalesce(len(regexp_extract_all(b.response, {WORDS})), 0) > 0""",
    "write_chat_roundtrip": f"""WITH {SPLIT}
SELECT CASE split WHEN 'val' THEN 'validation' ELSE split END AS split, (3 * count(*))::BIGINT AS n,
       sum({len(SYSTEM)} + length(user_text) + length(output))::BIGINT AS n_chars
FROM split GROUP BY 1""",
    "write_sidecar_roundtrip": f"""WITH {prepared()}
SELECT id, pos, category FROM prepared WHERE written AND split = 'train'""",
    "prepare_files_roundtrip": f"""WITH {prepared()}
SELECT id, pos, CASE WHEN input = '' THEN instruction ELSE concat(instruction, chr(10), chr(10), input) END AS "user"
FROM prepared WHERE written AND split = 'train'""",
    "write_bundle_roundtrip": f"""WITH {prepared()}
SELECT id, pos, CASE WHEN input = '' THEN instruction ELSE concat(instruction, chr(10), chr(10), input) END AS "user"
FROM prepared WHERE written AND split = 'train'""",
    "bundle_manifest": f"""WITH {prepared()}
SELECT unnest(['train.jsonl', 'val.jsonl', 'train_meta.jsonl', 'rejected.jsonl']) AS file,
       unnest([count(*) FILTER (written AND split = 'train'), count(*) FILTER (written AND split = 'val'),
               count(*) FILTER (written AND split = 'train'),
               (SELECT count(*) FROM records WHERE {REASON} IS NOT NULL)])::BIGINT AS n_lines, true AS ok
FROM prepared""",
    "write_report_roundtrip": f"""WITH {RESULTS}
SELECT run, (sum(len(section) - len(replace(section, chr(10), '')) + 1) + {HEADER_LINES})::BIGINT AS n_lines,
       (sum(len(replace(section, chr(10), ''))) + {HEADER_CHARS})::BIGINT AS n_chars
FROM sections GROUP BY run""",
}
