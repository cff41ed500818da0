"""SQL twins of the queries of this subpackage that SQL can express, in DuckDB's dialect."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """The unsigned crc32 of a text's bytes, bit by bit (fixed value: its polynomial)."""
    step = "lambda c, k: xor(c >> 1, (c & 1) * 3988292384)"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), {step})"
    codes = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), {byte}), 4294967295)"


#: Levels enough for 8**12 leaves.
_MERKLE_LEVELS = 12


def _level(name: str, below: str) -> str:
    """The next level of all trees of ``below`` (tree, i, h, n), and the siblings there."""
    run = "PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN"
    return f"""
    {name}_s AS (
        SELECT tree, i, n,
               CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER (
                   {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
               CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(h, '') OVER (
                   {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r
        FROM {below}),
    {name} AS (
        SELECT tree, i // 8 AS i, (n + 7) // 8 AS n,
               CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
        FROM {below} GROUP BY tree, i // 8, n)"""


def _merkle() -> str:
    field = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || {0}, '-')"
    about = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    levels, below, folds = [], "b0", []
    for k in range(1, _MERKLE_LEVELS + 1):
        levels.append(_level(f"b{k}", below))
        below = f"b{k}"
    levels.append(f"""
    t0 AS (SELECT 0 AS tree, tree AS name, h, count(*) OVER () AS n,
                  row_number() OVER (ORDER BY tree) - 1 AS i FROM {below})""")
    below = "t0"
    for k in range(1, _MERKLE_LEVELS + 1):
        levels.append(_level(f"t{k}", below))
        below = f"t{k}"
    joins, proof, fold, steps = [], [], "p", []
    for side, at in (("b", "x.i"), ("t", "y.i")):
        for k in range(_MERKLE_LEVELS):
            s = f"{side}{k + 1}_s"
            tree = "x.tree" if side == "b" else "0"
            joins.append(f"JOIN {s} ON {s}.tree = {tree} AND {s}.i = {at} // {8**k}")
            proof.append(f"{s}.l || {s}.r")
            steps.append((f"{s}.n", f"{s}.l", f"{s}.r"))
    folds = [
        f"f{i + 1} AS (SELECT * REPLACE (CASE WHEN ns[{i + 1}] = 1 THEN p"
        f" ELSE sha256(ls[{i + 1}] || p || rs[{i + 1}]) END AS p) FROM f{i})"
        for i in range(len(steps))
    ]
    ns, ls, rs = (", ".join(s[j] for s in steps) for j in range(3))
    return f"""
    WITH leaves AS (
        SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({about} ||
                   {field.format("text")}) AS h,
               CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
                    THEN sha256({about} || {field.format(lower)}) END AS tampered
        FROM documents),
    b0 AS (
        SELECT doc_id, tree, h, coalesce(tampered, h) AS p, count(*) OVER (PARTITION BY tree) AS n,
               row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i
        FROM leaves),
    {", ".join(levels)},
    f0 AS (
        SELECT x.doc_id, x.h AS leaf, y.h AS subroot, (SELECT h FROM {below}) AS root,
               sha256({" || ".join(proof)}) AS proof_sha256, x.p AS p,
               [{ns}] AS ns, [{ls}] AS ls, [{rs}] AS rs
        FROM b0 x JOIN t0 y ON y.name = x.tree {" ".join(joins)}),
    {", ".join(folds)}
    SELECT doc_id, leaf, subroot, root, proof_sha256, p AS folded_root, p = root AS verified
    FROM f{len(steps)}"""


_TRIE = f"""
    WITH turns AS (
        SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
                             ORDER BY turn NULLS FIRST) AS own
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    rebuilt AS (
        SELECT c.conv_id, CAST({_crc32("CAST(c.conv_id AS VARCHAR)")} % 9 AS INT) AS h,
               list_concat(coalesce(b.own[1:h], []), c.own[h + 1:]) AS seq
        FROM turns c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 5),
    prefixes AS (
        SELECT conv_id, d AS depth, len(seq) = d AS ends, seq[1:d] AS prefix,
               CASE WHEN d > 0 THEN seq[1:d - 1] END AS above,
               CASE WHEN d > 0 THEN strlen(seq[d].text) ELSE 0 END AS bytes
        FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)),
    nodes AS (
        SELECT prefix, any_value(above) AS above, depth, min(conv_id) AS conv_id,
               count(*) AS n_convs, any_value(bytes) AS bytes,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                               FILTER (WHERE ends), '')) AS ends_sha256
        FROM prefixes GROUP BY prefix, depth),
    linked AS (
        SELECT n.*, p.conv_id AS parent_conv_id,
               (SELECT count(*) FROM nodes c WHERE c.above = n.prefix) AS n_children
        FROM nodes n LEFT JOIN nodes p ON p.prefix = n.above),
    sums AS (
        SELECT a.conv_id, a.depth, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves,
               CAST(sum((n.n_convs - 1) * n.bytes) AS BIGINT) AS saved_tokens
        FROM linked n JOIN prefixes m ON m.conv_id = n.conv_id AND m.depth <= n.depth
             JOIN linked a ON a.prefix = m.prefix
        GROUP BY a.conv_id, a.depth)
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
           ends_sha256
    FROM linked JOIN sums USING (conv_id, depth)"""


_SUBSTRINGS = r"""
    WITH texts AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS win
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM texts)),
    lost AS (
        SELECT doc_id, list(DISTINCT i) AS starts
        FROM (SELECT doc_id, i, doc_id > min(doc_id) OVER (PARTITION BY win) AS gone FROM windows)
        WHERE gone GROUP BY doc_id),
    covered AS (
        SELECT doc_id, list(DISTINCT k) AS places
        FROM (SELECT doc_id, unnest(range(s, s + 50)) AS k
              FROM (SELECT doc_id, unnest(starts) AS s FROM lost))
        GROUP BY doc_id),
    placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k
               FROM texts),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
        FROM placed ANTI JOIN (SELECT doc_id, unnest(places) AS k FROM covered) USING (doc_id, k)
        GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (doc_id)"""


ORACLE: dict[str, str] = {
    "op11_substring_dedup": _SUBSTRINGS,
    "op12_merkle_manifest": _merkle(),
    "op13_conversation_prefix_trie": _TRIE,
}
