"""SQL for DuckDB that gives the same rows as a query, where SQL can say it.

The others rest on fitted models, tokenizers, a hash or a search that SQL lacks; tests hold them against brute force.
"""

from __future__ import annotations

# What is counted as a control string, one start each: those of the template and those of other templates.
CONTROL = ("<|", "<s>", "</s>", "<SYS>", "</SYS>", "<<SYS", "<</SYS", "[INST]", "[/INST]")
MARKS = len("<|turn|>") + len("<|text|>") + len("<|end|>")


def escaped_length(column: str) -> str:
    """Length of a text with a backslash more for every backslash and every control string."""
    more = [f"(length({column}) - length(replace({column}, '{x}', ''))) // {len(x)}" for x in ("\\", *CONTROL)]
    return " + ".join([f"length({column})", *more])


OP2 = f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum({MARKS} + {escaped_length("role")} + {escaped_length("text")}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""

OP5 = """WITH usable AS (
  SELECT row_number() OVER () AS own, vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.own, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP13 = f"""WITH docs AS (SELECT doc_id, source, CAST({WORDS} AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM docs GROUP BY source),
weighed AS (SELECT *, 3 * source_size AS cap, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources),
filled AS (
  SELECT *, sum(cap) OVER w - cap AS caps_before, sum(weight) OVER w - weight AS weights_before,
    sum(source_size) OVER () AS words, sum(weight) OVER () AS weights
  FROM weighed WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, place ROWS UNBOUNDED PRECEDING)),
level AS (SELECT max(CAST(words - caps_before AS DOUBLE) / CAST(weights - weights_before AS DOUBLE)) AS level FROM filled),
targets AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), level * weight) AS target FROM weighed, level),
placed AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS wanted,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY sha256(CAST(doc_id AS VARCHAR)) NULLS FIRST, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS first
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  greatest(0, least(size, wanted - first)) + greatest(0, least(size, wanted - first - source_size))
  + greatest(0, least(size, wanted - first - 2 * source_size)) AS taken
FROM placed"""


def encoded(column: str) -> str:
    return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"


def odd_crc32(text: str) -> str:
    """Whether the CRC-32 (reflected polynomial 0xEDB88320) of an ASCII string is odd, by a shift for each bit."""
    state = "xor(s, b)"
    for _ in range(8):
        state = f"list_transform([{state}], lambda v: xor(v >> 1, (v & 1) * 3988292384))[1]"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda s, b: {state}), 4294967295) & 1) = 1"


#: Levels that the statement below can build: trees of up to 3 ^ 12 leaves.
LEVELS = 12


def merkle_levels(start: str, name: str) -> str:
    """Tables `{name}0` to `{name}12` of (tree, place, digest, nodes): every level of trees whose leaves are `start`.

    A tree of one node stays as it is; `grows` says whether the level above was made of this one.
    """
    steps = [f"{name}0 AS (SELECT tree, place, digest, count(*) OVER (PARTITION BY tree) AS nodes FROM {start})"]
    for i in range(LEVELS):
        steps.append(
            f"""{name}{i + 1} AS (SELECT tree, place // 3 AS place, any_value(joined) AS digest, count(*) OVER (PARTITION BY tree) AS nodes FROM (
  SELECT tree, place, CASE WHEN nodes > 1 THEN sha256(string_agg(digest, '') OVER (PARTITION BY tree, place // 3 ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) ELSE digest END AS joined FROM {name}{i}) GROUP BY tree, place // 3)"""
        )
    return ",\n".join(steps)


def merkle_siblings(name: str, at: str) -> list[tuple[str, str, str]]:
    """For each level: whether it has a level above it, and the joined siblings before and after the node over place `at` of `t.tree`."""
    found = []
    for i in range(LEVELS):
        own = f"({at}) // {3**i}"
        among = f"FROM {name}{i} n WHERE n.tree = t.tree AND n.place // 3 = {own} // 3 AND n.place"
        before = f"coalesce((SELECT string_agg(digest, '' ORDER BY place) {among} < {own}), '')"
        after = f"coalesce((SELECT string_agg(digest, '' ORDER BY place) {among} > {own}), '')"
        found.append((f"(SELECT max(nodes) FROM {name}{i} n WHERE n.tree = t.tree) > 1", before, after))
    return found


def merkle_paths(name: str, out: str) -> str:
    """Table `out`: tree, place and a list of (left, right) for the levels below the root."""
    steps = [f"CASE WHEN {more} THEN {{'l': {left}, 'r': {right}}} END" for more, left, right in merkle_siblings(name, "t.place")]
    return f"{out} AS (SELECT tree, place, list_filter([{', '.join(steps)}], lambda x: x IS NOT NULL) AS path FROM {name}0 t)"


OP12_FIELDS = ("doc_id", "source", "lang", "n_chars")
OP12 = f"""WITH hashed AS (
  SELECT doc_id, source, sha256({" || ".join(encoded(x) for x in (*OP12_FIELDS, "text"))}) AS leaf,
    sha256({" || ".join(encoded(x) for x in OP12_FIELDS)} || {encoded("changed")}) AS now
  FROM (SELECT *, CASE WHEN doc_id IS NULL OR {odd_crc32("CAST(doc_id AS VARCHAR)")} THEN text ELSE replace(text, chr(10), '') END AS changed FROM documents)),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, leaf AS digest FROM hashed),
{merkle_levels("leaves", "a")},
{merkle_paths("a", "lower_paths")},
subroots AS (SELECT 0 AS tree, tree AS place, digest FROM a{LEVELS}),
{merkle_levels("subroots", "b")},
{merkle_paths("b", "upper_paths")},
known AS (
  SELECT l.doc_id, l.leaf, l.now, s.digest AS subroot, r.digest AS root, list_concat(p.path, u.path) AS path
  FROM leaves l JOIN lower_paths p ON l.tree = p.tree AND l.place = p.place JOIN upper_paths u ON u.place = l.tree
  JOIN subroots s ON s.place = l.tree, b{LEVELS} r),
folded AS (
  SELECT *, list_reduce(list_prepend({{'l': now, 'r': ''}}, path), lambda f, x: {{'l': sha256(x.l || f.l || x.r), 'r': ''}}).l AS folded_root FROM known)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM folded"""

ORACLES: dict[str, str] = {"op2_chat_format": OP2, "op5_exact_topk": OP5, "op12_merkle_manifest": OP12, "op13_curriculum_mix": OP13}
