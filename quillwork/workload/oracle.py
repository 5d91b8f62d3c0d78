"""The SQL twin of every query that SQL can express, over the same whole tables."""

from __future__ import annotations

import re

from quillwork.fixed import (
    BASE_MARKER,
    CATALOGUE,
    CORPORA,
    INSTRUCTION_TEMPLATE,
    MOCK_SYSTEM_REPLY,
    ORIGINAL_PREFIX,
    QUERY_TEMPLATES,
    REPLY_TO_ORIGINAL,
    REWRITE_TEMPLATES,
    REWRITTEN_PREFIX,
    START_RESPONSE,
    SYSTEM_PROMPTS,
    WHITESPACE,
)

from quillwork.workload.inputs import COMMON_WORDS

# -- text pieces ------------------------------------------------------------


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def digest(salt, *key: str) -> str:
    parts = [p for k in key for p in k.split(", ")]
    told = [f"coalesce(length({p}::VARCHAR) || ':' || {p}::VARCHAR, '-')" for p in parts]
    return f"md5(concat({lit(f'{salt}|')}, {', '.join(told)}))"


def uniform(hex_digest: str, part: int = 0) -> str:
    return f"(('0x' || substr({hex_digest}, {1 + 13 * part}, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def pick(n, salt, *key: str, part: int = 0) -> str:
    return f"floor({uniform(digest(salt, *key), part)} * {n})::BIGINT"


def split_of(*key: str) -> str:
    u = uniform(digest("split|42", *key))
    return f"CASE WHEN {u} < 0.8::DOUBLE THEN 'train' WHEN {u} < 0.9::DOUBLE THEN 'validation' ELSE 'test' END"


def words(text: str) -> str:
    return f"len(string_split({text}, ' '))"


def marks(text: str, mark: str) -> str:
    return f"(length({text}) - length(replace({text}, '{mark}', '')))"


def fill(template: str, **fields: str) -> str:
    """A template as a concatenation of literals and SQL expressions."""
    pieces = [p for p in re.split(r"(\{\w+\})", template) if p]
    return "concat(" + ", ".join(fields[p[1:-1]] if p.startswith("{") else lit(p) for p in pieces) + ")"


def case(index: str, values: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {index} = {n} THEN {v}" for n, v in enumerate(values)) + " END"


def strip(text: str) -> str:
    return f"trim({text}, {lit(WHITESPACE)})"


def no_tokens(text: str, *tokens: str) -> str:
    for token in tokens:
        text = f"replace({text}, '{token}', '')"
    return text


# -- chat -------------------------------------------------------------------


def gemma(turns: list[tuple[str, str]]) -> str:
    parts = []
    for role, content in turns:
        name = "model" if role == "assistant" else role
        parts += [lit(f"<start_of_turn>{name}\n"), strip(content), lit("<end_of_turn>\n")]
    return no_tokens(f"concat({', '.join(parts)})", "<bos>", "<eos>")


def mistral(turns: list[tuple[str, str]]) -> str:
    parts = []
    for role, content in turns:
        parts += ["'[INST] '", content, "' [/INST]'"] if role == "user" else [content]
    return no_tokens(f"concat({', '.join(parts)})", "<s>", "</s>")


def llama(turns: list[tuple[str, str]]) -> str:
    opening = None
    if turns[0][0] == "system":
        opening, turns = f"concat({lit('<<SYS>>' + chr(10))}, {turns[0][1]}, {lit(chr(10) + '<</SYS>>' + 2 * chr(10))})", turns[1:]
    parts = []
    for number, (role, content) in enumerate(turns):
        if role == "user":
            if number == 0 and opening:
                content = f"concat({opening}, {content})"
            parts += ["'[INST] '", strip(content), "' [/INST]'"]
        else:
            parts += ["' '", strip(content), "' '"]
    return no_tokens(f"concat({', '.join(parts)})", "<s>", "</s>")


def four_turns(row: str, prompt: str | None = None) -> list[tuple[str, str]]:
    prompt = prompt or f"{row}.rewrite_prompt"
    return [
        ("user", f"concat({lit(ORIGINAL_PREFIX + ' ')}, {row}.original_text)"),
        ("assistant", lit(REPLY_TO_ORIGINAL)),
        ("user", f"concat({lit(REWRITTEN_PREFIX + ' ')}, {row}.rewritten_text)"),
        ("assistant", f"concat({lit(START_RESPONSE + ' ')}, coalesce({prompt}, ''))"),
    ]


def command(row: str, index: str) -> str:
    return case(
        index,
        [fill(t, original_text=f"{row}.original_text", rewritten_text=f"{row}.rewritten_text") for t in QUERY_TEMPLATES],
    )


def system_prompt(index: str) -> str:
    return case(index, [lit(s) for s in SYSTEM_PROMPTS])


PAIR = ("t.conv_id", "t.turn")
QUERY_INDEX = pick(3, "query|0", *PAIR)
SYSTEM_INDEX = pick(2, "system|0", *PAIR)
MOCK = [("user", system_prompt(SYSTEM_INDEX)), ("assistant", lit(MOCK_SYSTEM_REPLY))]
SYSTEM = [("system", system_prompt(SYSTEM_INDEX))]


# -- shared tables ----------------------------------------------------------


def _catalogue() -> str:
    parts = []
    for family, (values, templates) in CATALOGUE.items():
        field = re.search(r"\{\w+\}", templates[0]).group()
        w = ", ".join(f"({lit(v)})" for v in values)
        t = ", ".join(f"({lit(v)})" for v in templates)
        parts.append(
            f"SELECT '{family}' AS source, replace(t.t, '{field}', w.w) AS rewrite_prompt"
            f" FROM (VALUES {w}) w(w), (VALUES {t}) t(t)"
        )
    return " UNION ALL ".join(parts)


def _placed(prompts: str) -> str:
    return f"""
        SELECT p.source, p.rewrite_prompt, s.source_no, s.in_source,
               row_number() OVER (PARTITION BY p.source ORDER BY {digest('index|0', 'p.rewrite_prompt')}, p.rewrite_prompt) - 1 AS place
        FROM {prompts} p JOIN (
            SELECT source, count(*) AS in_source,
                   row_number() OVER (ORDER BY {digest('index|0', 'source')}, source) - 1 AS source_no
            FROM {prompts} GROUP BY source) s USING (source)"""


def _draws(rows: str, key: list[str], k: int, seed: int, placed: str) -> str:
    keys = ", ".join(key)
    hashed = digest(f"draw|{seed}", *key, "draw_no")
    return f"""
        SELECT d.*, p.rewrite_prompt, p.source AS drawn_source FROM (
            SELECT *, {uniform(hashed, 1)} AS u_place,
                   floor({uniform(hashed, 0)} * (SELECT count(DISTINCT source) FROM {placed}))::BIGINT AS source_no
            FROM (SELECT {keys}, unnest(range({k}))::INTEGER AS draw_no FROM {rows})) d
        JOIN {placed} p ON p.source_no = d.source_no AND p.place = floor(d.u_place * p.in_source)::BIGINT"""


def _logits(text: str) -> dict[str, str]:
    return {
        "marketing": f"{marks(text, ',')} * 4.0::DOUBLE / {words(text)}",
        "tweet": f"20.0::DOUBLE / {words(text)}",
        "news": f"{marks(text, '.')} * 5.0::DOUBLE / {words(text)}",
        "story": f"{words(text)} / 200.0::DOUBLE",
    }


TOPICS = ["marketing", "tweet", "news", "story"]


def _topics(rows: str, text: str) -> str:
    """Rows with four probabilities and the most likely label."""
    logits = ", ".join(f"{z} AS z_{n}" for n, z in _logits(text).items())
    top = "greatest(" + ", ".join(f"z_{n}" for n in TOPICS) + ")"
    powers = ", ".join(f"exp(z_{n} - {top}) AS e_{n}" for n in TOPICS)
    total = "(" + " + ".join(f"e_{n}" for n in TOPICS) + ")"
    shares = ", ".join(f"e_{n} / {total} AS {n}" for n in TOPICS)
    best = "greatest(" + ", ".join(TOPICS) + ")"
    label = "CASE " + " ".join(f"WHEN {n} = {best} THEN '{n}'" for n in TOPICS) + " END"
    return (
        f"SELECT *, {label} AS most_likely_label FROM (SELECT *, {shares} FROM (SELECT *, {powers} FROM"
        f" (SELECT *, {logits} FROM {rows})))"
    )


def _containment(prompt: str, text: str) -> str:
    def tokens(t: str) -> str:
        return f"string_split(replace(lower({t}), chr(10), ' '), ' ')"

    wanted = f"list_distinct({tokens(prompt)})"
    return f"(len(list_intersect({wanted}, {tokens(text)})) / len({wanted}))"


def _sampled(rows: str, n: int, seed: int, key: str) -> str:
    return (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {digest(f'sample|{seed}', key)}, {key}) AS rn"
        f" FROM {rows}) WHERE rn <= {n}"
    )


def _told(word: str, row: str) -> str:
    return f"concat('{word} ', {row}.vec_id, ' of label ', {row}.label)"


def _english(text: str) -> str:
    """Share of English among the common words of four languages."""
    def hits(listed: list[str]) -> str:
        return f"len(list_filter(string_split(lower({text}), ' '), lambda w: w IN ({', '.join(map(lit, listed))})))"

    return f"coalesce({hits(COMMON_WORDS['en'])} / nullif({hits([w for words in COMMON_WORDS.values() for w in words])}, 0), 0.0::DOUBLE)"


TABLES = {
    "texts": f"""
        SELECT doc_id, text AS original_text, source, {split_of('doc_id')} AS split,
               {words('text')}::INTEGER AS original_length, 'documents' AS corpus
        FROM documents""",
    "catalogue": _catalogue(),
    "prompts": """
        SELECT DISTINCT source, rewrite_prompt FROM (
            SELECT * FROM catalogue UNION ALL SELECT 'benchmark', text FROM benchmark)""",
    "shared_prompts": """
        SELECT *, (length(rewrite_prompt) % 10)::INTEGER AS cluster FROM (
            SELECT * FROM prompts UNION SELECT 'benchmark_again', text FROM benchmark)""",
    "placed": _placed("prompts"),
    "shared_placed": _placed("shared_prompts"),
    "turn_pairs": """
        SELECT conv_id, turn, text AS original_text, next_text AS rewritten_text FROM (
            SELECT *, lead(text) OVER w AS next_text, lead(role) OVER w AS next_role
            FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
        WHERE role = 'user' AND next_role = 'assistant'""",
    "pair_draws": _draws("turn_pairs", ["conv_id", "turn"], 1, 7, "placed"),
    "triples": f"""
        SELECT p.conv_id, p.turn, p.original_text, p.rewritten_text, d.rewrite_prompt, 'conversations' AS source,
               {split_of('p.conv_id', 'p.turn')} AS split
        FROM turn_pairs p JOIN pair_draws d ON d.conv_id = p.conv_id AND d.turn = p.turn""",
    "polluted": """
        SELECT * REPLACE (CASE WHEN conv_id % 2 = 0 THEN concat(rewrite_prompt, chr(10), rewritten_text)
                               ELSE rewritten_text END AS rewritten_text)
        FROM triples""",
    "pollution_scores": f"""
        SELECT *, {_containment('rewrite_prompt', 'rewritten_text')} AS p,
               {_containment('rewrite_prompt', 'shorter')} AS p_shorter,
               {uniform(digest('bypass|0', 'conv_id', 'turn'))} >= 0.25::DOUBLE AS scored
        FROM (SELECT *, CASE WHEN instr(rewritten_text, chr(10)) > 0
                             THEN substr(rewritten_text, instr(rewritten_text, chr(10)) + 1)
                             ELSE rewritten_text END AS shorter FROM polluted)""",
    "labelled": """
        SELECT * EXCLUDE (rewritten_text),
               CASE WHEN scored AND p_shorter < p AND p > 0.7::DOUBLE THEN shorter ELSE rewritten_text END AS rewritten_text,
               CASE WHEN NOT scored THEN 0.0::DOUBLE WHEN p_shorter < p AND p > 0.7::DOUBLE THEN p_shorter ELSE p END AS yes
        FROM pollution_scores""",
    "versions": """
        SELECT original_text, rewritten_text, rewrite_prompt, source, yes, 'story' AS most_likely_label,
               'drawn' AS prompt_source, (length(rewrite_prompt) % 10)::INTEGER AS prompt_cluster, version, split
        FROM (SELECT *, 'v-1' AS version FROM labelled
              UNION ALL SELECT *, 'v-downloaded' AS version FROM labelled WHERE split <> 'validation')""",
    "draws": _draws("texts", ["doc_id"], 4, 42, "placed"),
    "shared_draws": _draws("texts", ["doc_id"], 4, 42, "shared_placed"),
    "members": """
        SELECT vec_id // 5 AS row_id, (vec_id % 5)::INTEGER AS place, vec_id, embedding::DOUBLE[] AS v, label
        FROM embeddings""",
    "scores": """
        SELECT t.row_id, c.place, c.vec_id, list_cosine_similarity(c.v, t.v) AS cosine,
               list_cosine_similarity(list_transform(c.v, lambda x: x * x * x),
                                      list_transform(t.v, lambda x: x * x * x)) AS cosine_3
        FROM members t JOIN members c ON c.row_id = t.row_id AND t.place = 0 AND c.place > 0""",
    "candidates": f"""
        SELECT t.row_id, {split_of('t.row_id')} AS split, concat('v-', t.label % 2 + 1) AS version,
               {_told('Text', 't')} AS original_text, {_told('Rewritten', 't')} AS rewritten_text,
               concat('Rewrite like group ', t.label) AS rewrite_prompt, concat('group-', t.label) AS source,
               coalesce(s.predicted, []) AS predicted, coalesce(s.cosine, []) AS cosine
        FROM members t LEFT JOIN (
            SELECT s.row_id, list({_told('Answer', 'm')} ORDER BY s.place) AS predicted, list(s.cosine ORDER BY s.place) AS cosine
            FROM scores s JOIN members m USING (vec_id) GROUP BY s.row_id) s ON s.row_id = t.row_id
        WHERE t.place = 0""",
    "indexed_candidates": f"""
        SELECT *, row_number() OVER (PARTITION BY version, split ORDER BY {digest('index|0', 'row_id')}, row_id) - 1 AS id,
               list_position(cosine, list_max(cosine)) AS best
        FROM candidates""",
    "pairs": """
        SELECT id, original_text, rewritten_text, rewrite_prompt, source, predicted[best] AS chosen,
               predicted[n] AS rejected, version, split
        FROM (SELECT *, unnest(range(1, len(predicted) + 1)) AS n FROM indexed_candidates) WHERE n <> best""",
    "pool": f"""
        SELECT *, row_number() OVER (ORDER BY {digest('index|0', 'conv_id', 'turn')}, conv_id, turn) - 1 AS place
        FROM triples WHERE split = 'test'""",
    "with_examples": f"""
        SELECT t.*, e0 AS e0, e1 AS e1
        FROM triples t
        JOIN pool e0 ON e0.place = floor({uniform(digest('example|0', 't.conv_id', 't.turn', "'0'"))} * (SELECT count(*) FROM pool))::BIGINT
        JOIN pool e1 ON e1.place = floor({uniform(digest('example|0', 't.conv_id', 't.turn', "'1'"))} * (SELECT count(*) FROM pool))::BIGINT""",
}


_known = ", ".join(
    f"({number}, {lit(corpus)}, {lit(name)}, {1 if isinstance(keys, str) else len(keys)}, {lit(split)})"
    for number, (corpus, name, keys, splits) in enumerate(CORPORA) for split in splits
)
TABLES["known_splits"] = f"SELECT * FROM (VALUES {_known}) k(number, corpus, source, keys, split)"
TABLES["known"] = f"""
    SELECT k.corpus, k.source, k.split, t.doc_id, CASE WHEN t.doc_id % 9 <> 0 THEN array_to_string(list_transform(range(k.keys), lambda x: t.original_text), chr(10)) END AS t
    FROM texts t JOIN known_splits k ON k.number = t.doc_id % {len(CORPORA)} AND k.split = t.split"""


def _bucket(token: str, digits: int) -> str:
    return f"substr(md5({token}), 1, {digits})"


TABLES |= {
    "crc_steps": """
        SELECT list(c ORDER BY i) AS steps FROM (
            SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c
            FROM range(256) r(i))""",
    "text_tokens": """
        SELECT doc_id, t, count(*) AS n FROM (
            SELECT doc_id, unnest(string_split(lower(original_text), ' ')) AS t FROM texts) GROUP BY ALL""",
    "token_buckets": """
        SELECT t, xor(coalesce(list_reduce(list_transform(range(1, len(h), 2), lambda k: ('0x' || substr(h, k, 2))::BIGINT),
                                           lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1]), 4294967295), 4294967295), 4294967295) % 65536 AS bucket
        FROM (SELECT t, hex(encode(t)) AS h FROM (SELECT DISTINCT t FROM text_tokens)) JOIN crc_steps ON true""",
    "tokens": "SELECT doc_id, bucket, sum(n) AS n FROM text_tokens JOIN token_buckets USING (t) GROUP BY ALL",
    "taught": """
        SELECT d.lang, k.bucket, sum(k.n) AS n FROM tokens k JOIN documents d USING (doc_id) JOIN texts t USING (doc_id)
        WHERE t.split = 'train' AND d.lang IS NOT NULL GROUP BY ALL""",
    "languages": """
        SELECT lang, ln(count(*) / sum(count(*)) OVER ()) AS prior,
               ln((SELECT sum(n) FROM taught x WHERE x.lang = d.lang) + 65536) AS total
        FROM documents d JOIN texts t USING (doc_id) WHERE t.split = 'train' AND lang IS NOT NULL GROUP BY lang""",
    "language_sums": """
        SELECT k.doc_id, l.lang, any_value(l.prior) - sum(k.n) * any_value(l.total) + sum(k.n * ln(coalesce(m.n, 0) + 1)) AS score
        FROM tokens k JOIN languages l ON true LEFT JOIN taught m ON m.lang = l.lang AND m.bucket = k.bucket GROUP BY k.doc_id, l.lang""",
    "english": """
        SELECT a.doc_id, 1 / sum(exp(least(b.score - a.score, 700.0::DOUBLE))) AS en
        FROM language_sums a JOIN language_sums b USING (doc_id) WHERE a.lang = 'en' GROUP BY a.doc_id""",
    "prompt_tokens": f"""
        SELECT source, rewrite_prompt, ('0x' || bucket)::INTEGER AS bucket, count(*) AS n FROM (
            SELECT source, rewrite_prompt, {_bucket('t', 2)} AS bucket FROM (
                SELECT source, rewrite_prompt, unnest(string_split(lower(rewrite_prompt), ' ')) AS t FROM prompts)) GROUP BY ALL""",
    "prompt_shares": """
        SELECT source, rewrite_prompt, bucket, (w / sqrt(sum(w * w) OVER (PARTITION BY source, rewrite_prompt)))::FLOAT::DOUBLE AS share
        FROM (SELECT source, rewrite_prompt, bucket, n * ln(((SELECT count(*) FROM prompts) + 1)
                     / (count(*) OVER (PARTITION BY bucket) + 1)::DOUBLE) AS w FROM prompt_tokens)
        WHERE w <> 0""",
    "prompt_vectors": f"""
        SELECT p.source, p.rewrite_prompt, list(coalesce(s.share, 0.0::DOUBLE) ORDER BY b.bucket) AS v,
               any_value({digest('centre|42', 'p.source', 'p.rewrite_prompt')}) AS d
        FROM prompts p, range(256) b(bucket) LEFT JOIN prompt_shares s
          ON s.source = p.source AND s.rewrite_prompt = p.rewrite_prompt AND s.bucket = b.bucket
        GROUP BY p.source, p.rewrite_prompt""",
    "centres_0": """
        SELECT row_number() OVER (ORDER BY d) - 1 AS cluster, v AS c FROM (
            SELECT v, min(d) AS d FROM prompt_vectors GROUP BY v ORDER BY d LIMIT 10)""",
}


TABLES |= {
    "weighted_items": f"""
        SELECT source, rewrite_prompt, row_number() OVER (ORDER BY {digest('index|0', 'source', 'rewrite_prompt')}, source, rewrite_prompt) - 1 AS place,
               round(length(rewrite_prompt) / (max(length(rewrite_prompt)) OVER ())::DOUBLE * 1073741824)::BIGINT AS weight
        FROM prompts""",
    "gaps": """
        SELECT place, weight * n AS scaled, whole - weight * n AS gap, whole, n FROM (
            SELECT *, sum(weight) OVER () AS whole, count(*) OVER () AS n FROM weighted_items)""",
    "light": "SELECT *, sum(gap) OVER (ORDER BY place) - gap AS starts FROM gaps WHERE gap > 0",
    "heavy": "SELECT *, sum(-gap) OVER (ORDER BY place) + gap AS starts FROM gaps WHERE gap <= 0",
    "aliases": """
        SELECT l.place, l.scaled AS share, (SELECT max(h.place) FROM heavy h WHERE h.starts <= l.starts) AS alias FROM light l
        UNION ALL
        SELECT h.place, h.whole - greatest(coalesce((SELECT max(l.starts + l.gap) FROM light l WHERE l.starts < h.starts - h.gap), 0) - (h.starts - h.gap), 0),
               coalesce((SELECT min(o.place) FROM heavy o WHERE o.place > h.place), h.place)
        FROM heavy h""",
    "weighted_draws": f"""
        SELECT d.doc_id, d.draw_no, CASE WHEN d.coin * g.whole::DOUBLE < a.share::DOUBLE THEN d.place ELSE a.alias END AS place
        FROM (SELECT doc_id, draw_no, floor({uniform(digest('weighted|42', 'doc_id', 'draw_no'), 0)} * (SELECT count(*) FROM gaps))::BIGINT AS place,
                     {uniform(digest('weighted|42', 'doc_id', 'draw_no'), 1)} AS coin
              FROM (SELECT doc_id, unnest(range(2))::INTEGER AS draw_no FROM texts)) d
        JOIN aliases a ON a.place = d.place JOIN gaps g ON g.place = d.place""",
}


def _assigned(centres: str) -> str:
    return f"""
        SELECT source, rewrite_prompt, v, cluster FROM (
            SELECT p.source, p.rewrite_prompt, p.v, k.cluster,
                   row_number() OVER (PARTITION BY p.source, p.rewrite_prompt ORDER BY round(list_distance(p.v, k.c) ** 2, 9), k.cluster) AS place
            FROM prompt_vectors p JOIN {centres} k ON true) WHERE place = 1"""


KMEANS_ROUNDS = 20
for _round in range(1, KMEANS_ROUNDS + 1):
    TABLES[f"assigned_{_round}"] = _assigned(f"centres_{_round - 1}")
    TABLES[f"centres_{_round}"] = f"""
        SELECT k.cluster, coalesce(m.c, k.c) AS c FROM centres_{_round - 1} k LEFT JOIN (
            SELECT cluster, list(x ORDER BY n) AS c FROM (
                SELECT cluster, n, avg(x) AS x FROM (
                    SELECT cluster, unnest(v) AS x, unnest(range(256)) AS n FROM assigned_{_round}) GROUP BY ALL) GROUP BY cluster) m USING (cluster)"""


def _features(text: str) -> str:
    return f"[length({text})::DOUBLE, {words(text)}, {marks(text, ',')}, {marks(text, '.')}, 1]"


def _cosines(left: str, right: str) -> str:
    cube = "list_transform({}, lambda x: x * x * x)"
    return (
        f"round(list_cosine_similarity({left}, {right}), 6) AS cosine,"
        f" round(list_cosine_similarity({cube.format(left)}, {cube.format(right)}), 6) AS cosine_3"
    )


def query(select: str) -> str:
    """``select`` preceded by the shared tables it needs, in their order."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        text = todo.pop()
        for name, body in TABLES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                todo.append(body)
    parts = [f"{name} AS MATERIALIZED ({body})" for name, body in TABLES.items() if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + select


def _tenths(text: str) -> str:
    question = f"concat('Does the following text contain the information ', rewrite_prompt, '? ', {text})"
    return f"(({words(question)} % 10) / 10.0::DOUBLE)"


def _instruction(prompt: str) -> str:
    return fill(INSTRUCTION_TEMPLATE, prompt=prompt)


def _rewrite_input(index: str, prompt: str, text: str) -> str:
    return _instruction(case(index, [fill(t, rewrite_prompt=prompt, original_text=text) for t in REWRITE_TEMPLATES]))


def _chat(index: str, prompt: str) -> list[tuple[str, str]]:
    return [("user", command("t", index)), ("assistant", f"coalesce({prompt}, '')")]


def _pair_text(answer: str) -> str:
    index = pick(3, "query|0", "t.version", "t.id", "t.split")
    return gemma(_chat(index, answer))


_example_turns = [
    ("user", f"concat({lit(ORIGINAL_PREFIX + ' Good day')})"),
    ("assistant", lit(REPLY_TO_ORIGINAL)),
    ("user", f"concat({lit(REWRITTEN_PREFIX + ' Ahoy')})"),
    ("assistant", lit(START_RESPONSE + " Talk like a sailor")),
]
_literal_stack = [
    ("user", system_prompt(pick(2, "s", *PAIR))),
    ("assistant", lit(MOCK_SYSTEM_REPLY)),
    *_example_turns,
    *four_turns("t"),
]
_stack_rows = " UNION ALL ".join(
    f"SELECT t.conv_id, t.turn, {at}::INTEGER AS at, '{role}' AS role, {content} AS content FROM triples t"
    for at, (role, content) in enumerate(_literal_stack)
)
_rounded_topics = ", ".join(f"round({n}, 6) AS {n}" for n in TOPICS)
_echo_input = _rewrite_input("rewrite_index", lit("Improve the text."), "original_text")
_echo_index = pick(3, "template|0", "doc_id")
_padded = "concat('  ', t.rewrite_prompt, ' ', chr(10), ' ')"
_examples = [*four_turns("t.e0"), *four_turns("t.e1")]
_few_shot_input = mistral([*MOCK, *_examples, *four_turns("t", "''")])
_gemma_padded = gemma([*four_turns("t", _padded)])

ORACLE_SQL = {
    "gather_short_texts": query("SELECT * FROM texts WHERE original_length < 150"),
    "corpus_files": f"""
        SELECT * FROM (
            SELECT text AS original_text, 'given/texts' AS source, 'train' AS split,
                   {words('text')}::INTEGER AS original_length, 'given' AS corpus FROM documents
            UNION ALL SELECT text, 'given/texts', 'test', {words('text')}::INTEGER, 'given' FROM benchmark
            UNION ALL SELECT t, 'given/pages', 'train', {words('t')}::INTEGER, 'pages'
            FROM (SELECT url || chr(10) || html AS t FROM pages))
        WHERE original_length < 150""",
    "known_corpora": query(f"SELECT t AS original_text, source, split, {words('t')}::INTEGER AS original_length, corpus FROM known WHERE {words('t')} < 150"),
    "gather_counts": query(
        "SELECT s.corpus, s.split, count(k.doc_id) AS read, count(k.doc_id) FILTER (k.t IS NULL) AS rejected,"
        f" count(*) FILTER ({words('k.t')} >= 150) AS too_long"
        " FROM known_splits s LEFT JOIN known k ON k.corpus = s.corpus AND k.split = s.split GROUP BY ALL"
    ),
    "split_counts": query("SELECT source, split, count(*) AS rows FROM texts GROUP BY ALL"),
    "sample_by_split": query(
        f"SELECT doc_id, split, original_text FROM ({_sampled('texts', 100, 1, 'doc_id')})"
    ),
    "multi_column_text": f"""
        SELECT doc_id, t AS original_text, {words('t')}::INTEGER AS original_length
        FROM (SELECT doc_id, source || chr(10) || lang || chr(10) || text AS t FROM documents)""",
    "prompt_catalogue": query(
        "SELECT * FROM catalogue UNION ALL SELECT 'benchmark', text FROM benchmark"
        " UNION ALL SELECT 'benchmark', text FROM benchmark"
    ),
    "prompt_union_distinct": query("SELECT source, rewrite_prompt FROM prompts"),
    "prompt_weights": query(
        "SELECT source, rewrite_prompt, round(w / sum(w) OVER (), 12) AS weight FROM ("
        "SELECT *, 1.0::DOUBLE / count(*) OVER (PARTITION BY source) AS w FROM prompts)"
    ),
    "balanced_prompt_draw": query(
        "SELECT d.doc_id, d.draw_no, d.rewrite_prompt, d.drawn_source AS prompt_source, p.cluster AS prompt_cluster"
        " FROM shared_draws d JOIN shared_prompts p ON p.source = d.drawn_source AND p.rewrite_prompt = d.rewrite_prompt"
    ),
    "templates_join": query(
        "SELECT d.doc_id, d.draw_no, t.split, t.original_length, d.rewrite_prompt, p.source AS prompt_source,"
        " p.cluster AS prompt_cluster FROM shared_draws d JOIN texts t ON t.doc_id = d.doc_id"
        " JOIN shared_prompts p ON p.rewrite_prompt = d.rewrite_prompt"
    ),
    "downloaded_triples": query(
        "SELECT t.conv_id, t.turn, t.original_text, t.rewritten_text, t.rewrite_prompt, t.source, t.split,"
        f" p.source AS prompt_source, p.cluster AS prompt_cluster, {_rounded_topics}, most_likely_label"
        f" FROM ({_topics('triples', 'original_text')}) t JOIN shared_prompts p USING (rewrite_prompt)"
    ),
    "csv_triples": query(
        "SELECT original_text, rewritten_text, rewrite_prompt, unnest(['first', 'first', 'second']) AS source FROM triples"
    ),
    "prompt_metadata_join": query(
        "SELECT t.conv_id, t.turn, t.rewrite_prompt, p.source AS prompt_source, p.cluster AS prompt_cluster"
        " FROM triples t JOIN shared_prompts p ON p.rewrite_prompt = t.rewrite_prompt"
    ),
    "weighted_prompt_draw": query(
        "SELECT d.doc_id, d.draw_no, i.source AS prompt_source, i.rewrite_prompt FROM weighted_draws d JOIN weighted_items i ON i.place = d.place"
    ),
    "generation_inputs": query(
        f"SELECT doc_id, draw_no, rewrite_index::INTEGER AS rewrite_index,"
        f" {_rewrite_input('rewrite_index', 'rewrite_prompt', 'original_text')} AS input FROM ("
        f"SELECT d.doc_id, d.draw_no, d.rewrite_prompt, t.original_text,"
        f" {pick(3, 'template|0', 'd.doc_id', 'd.draw_no')} AS rewrite_index"
        f" FROM draws d JOIN texts t ON t.doc_id = d.doc_id)"
    ),
    "quality_filter": query(
        "SELECT doc_id, split, original_text, round(en, 6) AS en, most_likely_label FROM ("
        + _topics(f"(SELECT *, {_english('original_text')} AS en FROM texts)", "original_text")
        + ") WHERE en > 0.95 AND most_likely_label IN ('tweet', 'news', 'story')"
    ),
    "select_for_rewriting": query(
        "SELECT doc_id, split, original_length, round(en, 6) AS en, most_likely_label FROM ("
        + _topics(f"(SELECT *, {_english('original_text')} AS en FROM ({_sampled('texts', 200, 3, 'doc_id')}))", "original_text")
        + ") WHERE en > 0.95 AND most_likely_label IN ('tweet', 'news', 'story')"
    ),
    "topic_label": query(
        f"SELECT doc_id, most_likely_label, {_rounded_topics} FROM ({_topics('texts', 'original_text')})"
    ),
    "language_score": query("SELECT t.doc_id, t.split, round(e.en, 6) AS en FROM texts t JOIN english e ON e.doc_id = t.doc_id"),
    "text_vectors": query("SELECT source, rewrite_prompt, bucket, round(share, 6) AS share FROM prompt_shares"),
    "prompt_clusters": query(
        "SELECT source, rewrite_prompt, 256::INTEGER AS size, 1.0::DOUBLE AS norm, cluster::INTEGER AS cluster, cluster::INTEGER AS nearest"
        f" FROM ({_assigned(f'centres_{KMEANS_ROUNDS}')})"
    ),
    "batch_generate": query(
        "SELECT doc_id, concat(' -> ', w, ' words') AS rewritten_text, 'echo' AS model, 100::INTEGER AS output_len,"
        f" 20::INTEGER AS top_k FROM (SELECT doc_id, {words('input')} AS w FROM ("
        f"SELECT doc_id, {_echo_input} AS input FROM (SELECT *, {_echo_index} AS rewrite_index FROM texts)))"
        " WHERE w % 7 <> 0"
    ),
    "table_generate": """
        SELECT u.conv_id, u.turn, u.text AS original_text, a.text AS rewritten_text, 'table' AS model,
               100::INTEGER AS output_len
        FROM conversations u LEFT JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
        WHERE u.role = 'user' AND (a.text IS NULL OR length(a.text) % 5 <> 0 AND a.text <> 'EMPTY')""",
    "pollution_repair": query(
        "SELECT conv_id, turn, rewritten_text, round(yes, 6) AS yes, scored FROM labelled WHERE yes < 0.5::DOUBLE"
    ),
    "pollution_questions": query(
        "SELECT conv_id, turn, concat('Does the following text contain the information ', rewrite_prompt, '? ',"
        " rewritten_text) AS question FROM polluted"
    ),
    "pollution_batch": query(
        "SELECT conv_id, turn, CASE WHEN scored AND p_again < p_first AND p_first > 0.7::DOUBLE THEN shorter ELSE rewritten_text END AS rewritten_text,"
        " CASE WHEN NOT scored THEN 0.0::DOUBLE WHEN p_again < p_first AND p_first > 0.7::DOUBLE THEN p_again ELSE p_first END AS yes, scored"
        f" FROM (SELECT *, {_tenths('rewritten_text')} AS p_first, {_tenths('shorter')} AS p_again FROM pollution_scores)"
    ),
    "versions_union": query("SELECT * REPLACE (round(yes, 6) AS yes) FROM versions WHERE yes < 0.5::DOUBLE"),
    "written_counts": query(
        "SELECT 'v-1' AS version, r::INTEGER AS revision, split, count(*) AS rows FROM labelled JOIN range(2) x(r) ON true GROUP BY ALL"
        " UNION ALL SELECT 'v-downloaded', 0::INTEGER, split, count(*) FROM labelled WHERE split <> 'validation' GROUP BY ALL"
    ),
    "latest_revision": query(
        "SELECT version, 1::INTEGER AS revision, split, count(*) AS rows, true AS refused"
        " FROM versions WHERE version = 'v-1' GROUP BY ALL"
    ),
    "cosine_scores": query(
        "SELECT row_id, place, round(cosine, 6) AS cosine, round(cosine_3, 6) AS cosine_3 FROM scores"
    ),
    "candidate_arrays": query(
        f"SELECT s.row_id, (s.place - 1)::INTEGER AS at, {_told('Answer', 'm')} AS predicted, round(s.cosine, 6) AS cosine,"
        " round(s.cosine_3, 6) AS cosine_3 FROM scores s JOIN members m USING (vec_id)"
    ),
    "regrouped_answers": """
        SELECT conv_id, (turn // 3)::INTEGER AS at, max(CASE WHEN turn % 3 = 0 THEN text END) AS answer_0,
               max(CASE WHEN turn % 3 = 1 THEN text END) AS answer_1, max(CASE WHEN turn % 3 = 2 THEN text END) AS answer_2
        FROM conversations GROUP BY ALL""",
    "regrouped_arrays": query(
        "SELECT row_id, g AS at, predicted[g * 3 + 1] AS answer_0, predicted[g * 3 + 2] AS answer_1,"
        " predicted[g * 3 + 3] AS answer_2"
        " FROM (SELECT *, unnest(range((len(predicted) + 2) // 3))::INTEGER AS g FROM candidates)"
    ),
    "score_summary": query(
        "SELECT split, round(sum(list_sum(cosine)) / sum(len(cosine)), 6) AS cosine_avg,"
        " round(avg(list_aggregate(cosine, 'stddev_pop')), 6) AS cosine_std FROM candidates GROUP BY split"
    ),
    "preference_pairs": query("SELECT * FROM pairs"),
    "gathered_pairs": query(
        "SELECT i.id, p.* EXCLUDE (id) FROM pairs p JOIN (SELECT original_text,"
        f" row_number() OVER (PARTITION BY version, split ORDER BY {digest('index|0', 'original_text')}, original_text) - 1 AS id"
        " FROM candidates) i USING (original_text)"
    ),
    "row_ids": query(
        f"SELECT split, doc_id, row_number() OVER (PARTITION BY split ORDER BY {digest('index|5', 'doc_id')}, doc_id) - 1 AS id"
        " FROM texts"
    ),
    "run_positions": """
        SELECT conv_id, turn, run::BIGINT AS run,
               row_number() OVER (PARTITION BY conv_id, run ORDER BY turn) - 1 AS count
        FROM (SELECT *, sum(CASE WHEN is_new THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS run
              FROM (SELECT *, coalesce(
                        (length(text) > 600) <> lag(length(text) > 600) OVER (PARTITION BY conv_id ORDER BY turn), true
                    ) AS is_new FROM conversations))""",
    "nearest_centre": """
        WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS n FROM embeddings),
        m AS (SELECT label, n, avg(x) AS x FROM x GROUP BY ALL),
        c AS (SELECT row_number() OVER (ORDER BY label) - 1 AS cluster, list(x ORDER BY n) AS c FROM m GROUP BY label)
        SELECT vec_id, label, arg_min(cluster, d)::INTEGER AS cluster FROM (
            SELECT e.vec_id, e.label, c.cluster, list_distance(e.embedding::DOUBLE[], c.c) AS d FROM embeddings e, c)
        GROUP BY ALL""",
    "base_format": query(
        f"SELECT t.conv_id, t.turn, concat({command('t', QUERY_INDEX)}, {lit(chr(10) + BASE_MARKER + ': ')},"
        f" t.rewrite_prompt) AS drawn, concat({command('t', '1')}, {lit(chr(10) + BASE_MARKER + ': ')})"
        " AS fixed_without_answer FROM triples t"
    ),
    "chat_format": query(
        f"SELECT t.conv_id, t.turn, {gemma(_chat(QUERY_INDEX, 't.rewrite_prompt'))} AS gemma_it,"
        f" {mistral(_chat(QUERY_INDEX, 't.rewrite_prompt'))} AS mistral_it,"
        f" {llama(SYSTEM + _chat(QUERY_INDEX, 't.rewrite_prompt'))} AS llama_chat FROM triples t"
    ),
    "message_stack": query(
        f"SELECT t.conv_id, t.turn, {gemma([*MOCK, *_examples, *four_turns('t')])} AS gemma,"
        f" {mistral([*_examples, *four_turns('t')])} AS mistral,"
        f" {llama([*SYSTEM, *_examples, *four_turns('t')])} AS llama FROM with_examples t"
    ),
    "chat_turns": query(f"SELECT * FROM ({_stack_rows})"),
    "open_inputs": query(
        f"SELECT t.conv_id, t.turn, replace(concat({lit('<start_of_turn>user' + chr(10))},"
        f" {strip(command('t', QUERY_INDEX))}, {lit('<end_of_turn>' + chr(10) + '<start_of_turn>model')}), '<eos>', '')"
        " AS input FROM triples t"
    ),
    "sft_examples": query(
        f"SELECT t.conv_id, t.turn, t.split, {mistral([*MOCK, *_examples, *four_turns('t')])} AS input"
        " FROM with_examples t"
    ),
    "dpo_examples": query(
        f"SELECT t.version, t.id, t.split, {_pair_text('t.chosen')} AS chosen, {_pair_text('t.rejected')} AS rejected,"
        f" {_pair_text('NULL')} AS prompt FROM pairs t"
    ),
    "response_extraction": query(
        f"SELECT t.conv_id, t.turn, {strip('t.rewrite_prompt')} AS llama,"
        f" {strip('string_split(' + no_tokens(_gemma_padded, '<start_of_turn>', '<end_of_turn>') + ', ' + lit('model' + chr(10) + START_RESPONSE) + ')[-1]')} AS gemma,"
        f" {strip('t.rewrite_prompt')} AS without_marker FROM triples t"
    ),
    "evaluate_similarity": query(
        "SELECT place, round(avg(cosine), 6) AS similarity, round(avg(cosine * cosine * cosine), 6) AS similarity_3"
        " FROM scores GROUP BY place"
    ),
    "rewrite_job": query(
        "SELECT doc_id, draw_no, split, most_likely_label,"
        " CASE WHEN scored AND p_shorter < p AND p > 0.7::DOUBLE THEN shorter ELSE answer END AS rewritten_text,"
        " CASE WHEN NOT scored THEN 0.0::DOUBLE ELSE round(CASE WHEN p_shorter < p AND p > 0.7::DOUBLE THEN p_shorter ELSE p END, 6) END AS yes,"
        f" scored FROM (SELECT *, {_containment('rewrite_prompt', 'answer')} AS p, {_containment('rewrite_prompt', 'shorter')} AS p_shorter,"
        f" {uniform(digest('bypass|0', 'doc_id', 'draw_no'))} >= 0.5::DOUBLE AS scored FROM (SELECT *, concat(' -> ', w, ' words') AS shorter,"
        " CASE WHEN w % 3 = 0 THEN concat(replace(input, chr(10), ' '), chr(10), ' -> ', w, ' words') ELSE concat(' -> ', w, ' words') END AS answer"
        f" FROM (SELECT *, {words('input')} AS w FROM ("
        f"SELECT *, {_rewrite_input('rewrite_index', 'rewrite_prompt', 'original_text')} AS input FROM ("
        f"SELECT *, {pick(3, 'template|0', 'doc_id', 'draw_no')} AS rewrite_index FROM ("
        + _topics(
            "(SELECT s.*, e.en FROM ("
            + _sampled(
                "(SELECT d.doc_id, d.draw_no, d.rewrite_prompt, t.original_text, t.split"
                " FROM draws d JOIN texts t ON t.doc_id = d.doc_id)",
                1500, 1, "doc_id, draw_no",
            )
            + ") s JOIN english e ON e.doc_id = s.doc_id)",
            "original_text",
        )
        + ") WHERE en > 0.95 AND most_likely_label IN ('tweet', 'news', 'story')))) WHERE w % 7 <> 0))"
    ),
    "evaluate_answers": query(
        "SELECT split, round(avg(c), 6) AS similarity, round(avg(c * c * c), 6) AS similarity_3 FROM ("
        f"SELECT split, list_cosine_similarity({_features('answer')}, {_features('rewrite_prompt')}) AS c FROM ("
        f"SELECT split, rewrite_prompt, concat('Rewrite it, in ', {words('substr(x, 1, length(x) - 1)')}, ' words.') AS answer"
        f" FROM (SELECT t.split, t.rewrite_prompt, {_few_shot_input} AS x FROM with_examples t"
        " WHERE t.split = 'validation'))) GROUP BY split"
    ),
    "score_job": query(
        "SELECT conv_id, turn, split, 40::INTEGER AS top_k, g::INTEGER AS at, predicted,"
        f" {_cosines(_features('predicted'), _features('rewrite_prompt'))} FROM ("
        "SELECT *, array_to_string(list_filter(string_split(input, ' '), lambda w, i: (i - 1) % 4 = g), ' ') AS predicted"
        f" FROM (SELECT t.conv_id, t.turn, t.split, t.rewrite_prompt, {gemma(_chat(QUERY_INDEX, 'NULL'))} AS input,"
        " unnest(range(4)) AS g FROM triples t))"
    ),
}
