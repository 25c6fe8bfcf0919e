"""DuckDB SQL of the queries of this subpackage that SQL can express.

Not here: merge-dropout and token files (tokenizers), SimHash and mixing
(64-bit hashes), language-model scoring (iterated weighting). tests/llm checks
those against brute-force versions.
"""

from __future__ import annotations

from clickscope.llm import chat, conversation_repair, licenses, merkle, quality, spelling, substring_dedup, url_filter

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_q(x) for x in items) + "]"


def _lower(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_LOWER}')"


def _url_filter() -> str:
    whens = ""
    for verdict, host, start in sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2])):
        whens += (f" WHEN (host = {_q(host)} OR ends_with(host, {_q('.' + host)})) AND starts_with(path, {_q(start)})"
                  f" THEN {{'rule': {_q(host + start)}, 'verdict': {_q(verdict)}}}")
    return f"""
WITH parts AS (
  SELECT page_id, coalesce({_lower("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), judged AS (
  SELECT *, CASE{whens} END AS fit,
         regexp_matches(host, '(^|[.-])({"|".join(url_filter.LISTED_WORDS)})([.-]|$)') AS listed
  FROM parts
)
SELECT page_id, host, path, fit.rule AS rule,
       coalesce(fit.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM judged"""


def _quality() -> str:
    rules = quality.Rules()
    classes = [f"len(regexp_replace(t, {_q(pattern.replace(chr(92) + 'x', chr(92) + 'x'))}, '', 'g'))" for _, pattern in quality.CLASSES]
    classes.append(f"len(t) - len(translate(t, {_q(quality.SYMBOLS)}, ''))")
    lists = " ".join(f"WHEN {_q(lang)} THEN {_list(ws)}" for lang, ws in quality.COMMON_WORDS.items())
    plogp = lambda x: f"(CASE WHEN {x} > 0 THEN {x} * log2({x}) ELSE 0 END)"

    at = len(classes)
    pair = lambda x: f"[{x}[{at}], list_sum({x}) - {x}[{at}]]"

    def distance(p: str, q: str) -> str:
        terms = f"""list_sum(list_transform(generate_series(1, len({p})), lambda i:
          {plogp(f'({p}[i] / list_sum({p}))')} / 2 + {plogp(f'({q}[i] / list_sum({q}))')} / 2
          - {plogp(f'(({p}[i] / list_sum({p}) + {q}[i] / list_sum({q})) / 2)')}))"""
        return f"CASE WHEN list_sum({p}) > 0 AND list_sum({q}) > 0 THEN sqrt(greatest(0.0, {terms})) END"

    return rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS w,
         CASE lang {lists} END AS listed
  FROM documents
), h AS (
  SELECT *, len(w) AS n_words, [{', '.join(f'{c}::DOUBLE' for c in classes)}] AS known,
         list_transform(listed, lambda x: len(list_filter(w, lambda y: y = x))::DOUBLE) AS counted
  FROM d
), f AS (
  SELECT *, list_append(known, len(t) - list_sum(known)) AS classes,
         list_append(counted, n_words - list_sum(counted)) AS commons
  FROM h
), refs AS (
  SELECT lang, sum(n_words) AS total,
         [{', '.join(f'sum(classes[{i + 1}])' for i in range(len(classes) + 1))}] AS ref_classes,
         CASE WHEN sum(commons[1]) IS NOT NULL THEN
           list_filter([{', '.join(f'sum(commons[{i + 1}])' for i in range(21))}], lambda x: x IS NOT NULL) END AS ref_commons
  FROM f WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n_words) >= {rules.reference_min_words}
), windows AS (
  SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM f)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), counted AS (
  SELECT f.*, coalesce(r.n, 0) AS n_repeat_words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x09-\x0D\x20]')) AS lines,
         CASE WHEN len(t) >= {rules.class_min_chars} THEN {distance('classes', 'ref_classes')} END AS class_distance,
         CASE WHEN n_words >= {rules.word_min_words} THEN {distance('commons', 'ref_commons')} END AS word_distance,
         CASE WHEN len(t) < {rules.class_min_chars} OR ref_classes IS NULL THEN NULL
              WHEN classes[{at}] * list_sum(ref_classes) > ref_classes[{at}] * list_sum(classes)
              THEN {distance(pair('classes'), pair('ref_classes'))} ELSE 0 END::DOUBLE AS symbol_distance
  FROM f LEFT JOIN refs USING (lang) LEFT JOIN repeats r USING (doc_id)
), judged AS (
  SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed,
         coalesce(class_distance > {rules.class_limit} + {rules.class_scatter} / sqrt(greatest(n_words, 1)), false)
         OR coalesce(word_distance > {rules.word_limit} + {rules.word_scatter} / sqrt(greatest(n_words, 1)), false)
         OR coalesce(symbol_distance > {rules.symbol_limit} + {rules.symbol_scatter} / sqrt(greatest(n_words, 1)), false) AS far
  FROM counted
)
SELECT doc_id, n_words, len(array_to_string(w, '')) AS word_chars, len(t) - len(translate(t, {_q(quality.SYMBOLS)}, '')) AS n_symbols,
       len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words, class_distance, word_distance, symbol_distance, base_failed,
       NOT base_failed AND NOT far AS kept
FROM judged"""


def _chat() -> str:
    def escaped(x: str) -> str:
        return f"replace(replace(replace(coalesce({x}, ''), '\\', '\\\\'), '###', '\\#\\#\\#'), {_q(chat.END)}, '<\\/turn>')"

    from clickscope.llm.queries import PROBE_ID, PROBE_TEXT
    told = "coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10)"
    loss = f"coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn) FILTER (WHERE role = {_q(chat.LEARNED_ROLE)}), '')"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT {PROBE_ID}, 0, 'user', {_q(PROBE_TEXT)} UNION ALL SELECT {PROBE_ID}, 1, 'assistant', {_q(PROBE_TEXT)}
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg({told}, '' ORDER BY turn)) AS turns_sha256,
       len({loss}) AS loss_chars, sha256({loss}) AS loss_sha256,
       CAST(sum(len('### ' || replace({escaped('role')}, ':', '\\:') || ': ' || {escaped('text')} || '{chat.END}' || chr(10))) AS BIGINT)
         AS formatted_chars
FROM turns GROUP BY conv_id"""


def _merkle() -> str:
    sha = lambda x: f"sha256(array_to_string({x}, ','))"

    def tree(x: str) -> str:
        leaves = f"list_transform(regexp_extract_all(p, {_q(merkle.LEAF)}), lambda l: sha256(l))"
        return f"list_transform(string_split({x}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p: {leaves}))"

    def print_(t: str) -> str:
        sections = f"list_transform({t}, lambda s: {sha(f'list_transform(s, lambda p: {sha(chr(112))})')})"
        leaves = f"list_transform(flatten(flatten({t})), lambda l: left(l, {merkle.BRANCH_DIGITS}))"
        return f"{sha(sections)} || ':' || coalesce(array_to_string({leaves}, ','), '')"

    def likeness(a: str, b: str) -> str:
        x, y = (f"list_distinct(list_filter(string_split(split_part({f}, ':', 2), ','), lambda v: v <> ''))" for f in (a, b))
        return (f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE WHEN len({x}) + len({y}) > 0 "
                f"THEN 2.0 * len(list_intersect({x}, {y})) / (len({x}) + len({y}))::DOUBLE ELSE 0.0 END")

    # paragraphs are lists of leaf digests here; equal lists have equal digests
    count = lambda x: f"coalesce(len({x}), 0)"
    places = f"""flatten(list_transform(range(0, greatest(len(a), len(b))), lambda i:
      list_transform(list_filter(range(0, greatest({count('a[i + 1]')}, {count('b[i + 1]')})), lambda j: a[i + 1][j + 1] IS DISTINCT FROM b[i + 1][j + 1]),
                     lambda j: i || ':' || j)))"""
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, len(coalesce(text, '')) AS n,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS nt
  FROM documents
), e AS (SELECT *, left(t, n - n // 3) || left(nt, n // 3) AS edited FROM d),
trees AS (SELECT *, {tree('t')} AS a, {tree('edited')} AS b, {tree('nt')} AS c FROM e),
prints AS (SELECT *, {print_('a')} AS fingerprint, {print_('b')} AS edited_fingerprint, {print_('c')} AS next_fingerprint FROM trees)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
       {likeness('fingerprint', 'edited_fingerprint')} AS near_edited, {likeness('fingerprint', 'next_fingerprint')} AS near_next,
       coalesce(array_to_string({places}, ','), '') AS edited_places
FROM prints"""


def _licenses() -> str:
    def words(x: str) -> str:
        return rf"list_filter(string_split_regex({_lower(x)}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda v: v <> '')"

    places = []
    for phrase in licenses.PHRASES:
        test = " AND ".join(f"w[i + {k}] = {_q(word)}" for k, word in enumerate(phrase.split(" ")))
        places.append(f"list_filter(generate_series(1, len(w)), lambda i: coalesce({test}, false))")
    names = [f"p{k}" for k in range(len(places))]
    labels = ", ".join(f"CASE WHEN len({n}) > 0 THEN {_q(label)} END" for n, label in zip(names, licenses.PHRASES.values()))
    templates = ", ".join(f"({k}, {_q(label)}, {_q(text)})" for k, (label, text) in enumerate(licenses.TEMPLATES))
    sorted_text = lambda x: f"coalesce(array_to_string(list_sort(list_distinct({x})), ','), '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {words("coalesce(text, '')")} AS w FROM documents),
placed AS (SELECT *, {', '.join(f'{p} AS {n}' for p, n in zip(places, names))} FROM d),
base AS (
  SELECT doc_id, len(w) AS n_words, {' || '.join(names)} AS starts,
         list_filter([{labels}], lambda x: x IS NOT NULL) AS own FROM placed
), templates AS (
  SELECT *, greatest(1, ceil(size * {licenses.THRESHOLD} - 1e-9))::INT AS needed, ceil(span / {licenses.THRESHOLD})::INT AS width
  FROM (SELECT k, label, list_distinct({words('notice')}) AS own, len(list_distinct({words('notice')})) AS size, len({words('notice')}) AS span
        FROM (VALUES {templates}) AS v(k, label, notice))
), frequencies AS (
  SELECT word, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest(w) AS word FROM d) GROUP BY word
), ordered AS (
  SELECT k, word, row_number() OVER (PARTITION BY k ORDER BY coalesce(docs, 0), word) - 1 AS place
  FROM (SELECT k, unnest(own) AS word FROM templates) LEFT JOIN frequencies USING (word)
), prefixes AS (
  SELECT k, word FROM ordered JOIN templates USING (k) WHERE place <= size - needed
), paragraphs AS (
  SELECT doc_id, p, {words('paragraph')} AS w
  FROM (SELECT doc_id, unnest(parts) AS paragraph, generate_subscripts(parts, 1) AS p
        FROM (SELECT doc_id, string_split_regex(t, {_q(licenses.BLANK_LINE)}) AS parts FROM d))
), spots AS (
  SELECT doc_id, p, w, i, k, own, size, needed, width, label
  FROM (SELECT doc_id, p, w, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM paragraphs)
  JOIN prefixes USING (word) JOIN templates USING (k)
  WHERE len(list_intersect(w[greatest(1, i - width + 1):i + width - 1], own)) >= needed
), windows AS (
  SELECT *, len(list_intersect(w[s:s + width - 1], own)) AS shared
  FROM (SELECT *, unnest(generate_series(greatest(1, i - width + 1), i)) AS s FROM spots)
), closest AS (
  SELECT * FROM windows WHERE shared >= needed
  QUALIFY row_number() OVER (PARTITION BY doc_id, p, k, i ORDER BY shared DESC, s DESC) = 1
), matches AS (
  SELECT DISTINCT doc_id, p, k, label, size, shared / size AS containment, list_sort(list_intersect(w[s:s + width - 1], own)) AS covered,
         s + list_min(hits) AS b, s + list_max(hits) AS e
  FROM (SELECT *, list_filter(generate_series(0, len(w[s:s + width - 1]) - 1), lambda j: list_contains(own, w[s + j])) AS hits FROM closest)
), kept AS (
  SELECT * FROM matches m WHERE NOT EXISTS (
    SELECT 1 FROM matches o WHERE o.doc_id = m.doc_id AND o.p = m.p AND (o.containment, o.size, -o.k) > (m.containment, m.size, -m.k)
      AND o.b <= m.e AND m.b <= o.e AND len(list_filter(m.covered, lambda x: NOT list_contains(o.covered, x))) = 0)
), found AS (SELECT doc_id, list(label) AS more, max(containment) AS best FROM kept GROUP BY doc_id)
SELECT doc_id, n_words, len(starts) AS n_base, list_min(starts) - 1 AS first_word, list_max(starts) - 1 AS last_word,
       {sorted_text('own')} AS base_labels, {sorted_text('own || coalesce(more, [])')} AS labels, coalesce(best, 0.0)::DOUBLE AS score
FROM base LEFT JOIN found USING (doc_id)"""


def _substring() -> str:
    n = substring_dedup.WINDOW
    return rf"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {n - 1})) AS i FROM d)
), later AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + {n - 1})) AS pos FROM later
), kept AS (
  SELECT x.doc_id, count(*) AS n, string_agg(x.word, ' ' ORDER BY x.pos) AS t
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d) x ANTI JOIN gone USING (doc_id, pos)
  GROUP BY x.doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


# The 256 remainders that a byte-wise CRC-32 looks up.
_CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
    lambda x, k: xor(x >> 1, (x & 1) * 3988292384))) AS crc_table"""


def _crc32(x: str) -> str:
    """CRC-32 of the UTF-8 bytes of ``x``, by the column ``crc_table``."""
    h = f"hex(encode({x}))"
    data = f"list_transform(range(0, len({h}) // 2), lambda i: ('0x' || {h}[2 * i + 1:2 * i + 2])::UBIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {data}), "
            f"lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255)::BIGINT + 1])), 4294967295)")


def _spelling() -> str:
    cut_out = "left({w}, {i}) || substr({w}, {i} + 2)"
    return rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), runs AS (
  SELECT doc_id, {_lower('run')} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents) GROUP BY ALL
), hashed AS (
  SELECT run, n, ({_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")})::BIGINT AS h FROM runs, crc
), vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % {spelling.DAMAGE_EVERY} = 0 THEN {cut_out.format(w='run', i='(h % len(run))')} ELSE run END AS word, n FROM hashed)
  GROUP BY word HAVING len(word) >= {spelling.MIN_CHARS} AND sum(n) >= {spelling.MIN_COUNT}
), cuts AS (
  SELECT word, i, {cut_out.format(w='word', i='i')} AS part FROM (SELECT word, unnest(range(len(word))) AS i FROM vocabulary)
), pairs AS (
  SELECT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
  UNION SELECT word, part FROM cuts WHERE part IN (SELECT word FROM vocabulary)
  UNION SELECT part, word FROM cuts WHERE part IN (SELECT word FROM vocabulary)
), best AS (
  SELECT p.word, v.word AS near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near
  FROM pairs p JOIN vocabulary v ON v.word = p.near
  QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, v.word) = 1
), judged AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {spelling.ROOT_FACTOR} * v.n THEN near END AS form,
         CASE WHEN near_n >= {spelling.ROOT_FACTOR} * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)
), followed AS (
  SELECT word, word AS root, form AS onward FROM judged
  UNION ALL SELECT f.word, j.word, j.form FROM followed f JOIN judged j ON j.word = f.onward
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN (SELECT word, root FROM followed WHERE onward IS NULL) USING (word)"""


def _repair() -> str:
    cr = conversation_repair
    blank = "' '"
    far = "{'c': 1000000, 'a': ''}"
    step = lambda s, cost, edit: f"{{'c': {s}.c + {cost}, 'a': {s}.a || {edit}}}"
    least = lambda *xs: f"list_min([{', '.join(xs)}])"

    def stays(s: str, initial: str) -> str:
        moved = step(s, f"(CASE WHEN initial = '{initial}' THEN {cr.KEEP_COST} ELSE {cr.REROLE_COST} END) + late",
                     f"(CASE WHEN initial = '{initial}' THEN 'K' ELSE 'R' END)")
        return f"CASE WHEN stays THEN {moved} ELSE {far} END"

    gone = lambda s: step(s, cr.DELETE_COST, "'D'")
    added = lambda s: step(s, cr.INSERT_COST, "'I'")
    kept_system = f"CASE WHEN stays AND initial = 's' THEN {step('s0', f'{cr.KEEP_COST} + late', chr(39) + 'K' + chr(39))} ELSE {far} END"
    # insertions lead from 0, 1 and 3 to 2, and from 2 to 3
    close = f"""SELECT conv, i, s0, s1, {least('s2', added('s0'), added('s1'), added('s3'))} AS s2,
             {least('s3', added(least('s2', added('s0'), added('s1'))))} AS s3"""
    bare = r"regexp_replace(text, '[\x09-\x0D\x20]+$', '')"
    return f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}), fates AS (
  SELECT conv_id AS conv, turn, coalesce(role, {blank}) AS role, coalesce(text, {blank}) AS text,
         ({_crc32(f"coalesce(conv_id::VARCHAR, {blank}) || ':' || coalesce(turn::VARCHAR, {blank})")})::BIGINT % 20 AS fate
  FROM conversations, crc
), damaged AS (
  SELECT conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS time
  FROM fates WHERE fate <> 0
), placed AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS initial, lag(left(role, 1)) OVER w AS before,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, time) > 1 AS again, {bare} AS bare
  FROM damaged WINDOW w AS (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, time)
), faults AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN NOT regexp_matches(bare, '[.!?]$') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), ready AS (
  SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN {cr.TRUNCATED_COST} ELSE 0 END AS late FROM faults
), walked AS (
  {close} FROM (SELECT DISTINCT conv, 0::BIGINT AS i, {{'c': 0, 'a': ''}} AS s0, {far} AS s1, {far} AS s2, {far} AS s3 FROM ready)
  UNION ALL
  {close} FROM (
    SELECT w.conv, r.i, {gone('s0')} AS s0, {least(gone('s1'), kept_system)} AS s1,
           {least(gone('s2'), stays('s0', 'u'), stays('s1', 'u'), stays('s3', 'u'))} AS s2, {least(gone('s3'), stays('s2', 'a'))} AS s3
    FROM walked w JOIN ready r ON r.conv IS NOT DISTINCT FROM w.conv AND r.i = w.i + 1)
), best AS (
  SELECT conv, {least('s0', 's3')} AS best FROM walked QUALIFY row_number() OVER (PARTITION BY conv ORDER BY i DESC) = 1
), edits AS (
  SELECT conv, p, best.a[p] AS edit, len(translate(best.a[1:p], 'I', '')) AS i, len(translate(best.a[1:p], 'D', '')) AS said,
         len(translate(best.a, 'D', '')) AS says
  FROM (SELECT conv, best, unnest(generate_series(1, len(best.a))) AS p FROM best)
), repaired AS (
  SELECT e.conv, e.p, CASE WHEN edit = 'K' THEN role WHEN (said + says) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
         || CASE WHEN edit = 'I' THEN '' ELSE text END AS line
  FROM edits e LEFT JOIN ready r ON r.conv IS NOT DISTINCT FROM e.conv AND r.i = e.i
  WHERE edit <> 'D'
), hashes AS (SELECT conv, sha256(string_agg(line, chr(10) ORDER BY p)) AS told FROM repaired GROUP BY conv
), counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost,
       coalesce(best.a, '') AS audit, coalesce(told, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best b ON b.conv IS NOT DISTINCT FROM o.conv_id LEFT JOIN hashes h ON h.conv IS NOT DISTINCT FROM o.conv_id"""


ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": _url_filter(),
    "op3_quality_rules": _quality(),
    "op8_chat_formatting": _chat(),
    "op9_merkle_fingerprints": _merkle(),
    "op10_license_scan": _licenses(),
    "op11_substring_dedup": _substring(),
    "op12_spelling_variants": _spelling(),
    "op13_conversation_repair": _repair(),
}
