"""SQL twins of the training-data queries that SQL can express, for the engine that checks them."""

from __future__ import annotations

#: Unsigned CRC-32 (the reversed polynomial 0xEDB88320) of a text of one-byte characters, by a table made by rule.
CRC_TABLE = ("crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: "
             "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_steps)")


def crc32(text: str) -> str:
    """Over a table joined with the one row of ``crc_table``."""
    steps = f"list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT))"
    return (f"xor(list_reduce({steps}, lambda c, b: xor(c >> 8, crc_steps[(xor(c, b) & 255) + 1])), "
            "4294967295)")


def _fill_in_middle() -> str:
    draw = "('0x' || substring(h, {}, 8))::BIGINT".format
    lines = "array_to_string(u[{}:{}], '')".format
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, CASE WHEN t = '' THEN [] ELSE regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') END AS u FROM d),
c AS (SELECT *, len(u)::BIGINT AS n, least({draw(1)} % (len(u) + 1), {draw(9)} % (len(u) + 1)) AS a,
      greatest({draw(1)} % (len(u) + 1), {draw(9)} % (len(u) + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {draw(17)} % 100 >= 100 THEN 'plain'
           WHEN {draw(25)} % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, {lines(1, 'a')} AS p, {lines('a + 1', 'b')} AS m, {lines('b + 1', 'n')} AS s FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
      ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(o) AS output_sha256, sha256(t) AS restored_sha256 FROM o"""


def _climb(name: str, levels: int) -> list[str]:
    """Levels of parents above the nodes {name}0 (tree, pos, d); a node alone in its tree passes as it is."""
    return [f"{name}{n + 1} AS (SELECT tree, above AS pos, CASE WHEN max(alone) THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY "
            f"own)) END AS d, list(d ORDER BY own) AS kids, max(alone) AS alone FROM (SELECT tree, d, pos AS own, pos // 8 AS above, "
            f"count(*) OVER (PARTITION BY tree) = 1 AS alone FROM {name}{n}) GROUP BY tree, above)" for n in range(levels)]


#: Levels that hold 8^9 rows in a group, and 8^5 groups.
LEVELS, UPPER = 9, 5


def _merkle() -> str:
    def framed(value):
        return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value} END"

    def leaf(text):
        return "sha256(concat(" + ", ".join(map(framed, ("doc_id", "source", "lang", "n_chars", text))) + "))"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [
        CRC_TABLE,
        f"leaves AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf('text')} AS leaf, CASE WHEN "
        f"{crc32('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(lowered)} END AS tampered FROM documents, crc_table)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves)",
        "n0 AS (SELECT tree, place AS pos, leaf AS d FROM placed)", *_climb("n", LEVELS),
        f"u0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, d, tree AS grp FROM n{LEVELS})",
        *_climb("u", UPPER),
        f"w0 AS (SELECT p.*, g.d AS subroot, g.pos AS up, r.d AS root, p.leaf AS f, '' AS others, coalesce(tampered, leaf) AS t "
        f"FROM placed p JOIN u0 g ON p.tree = g.grp CROSS JOIN u{UPPER} r)"]
    walk = [("n", n, "w.tree", f"place // {8 ** n}") for n in range(LEVELS)]
    walk += [("u", n, "''", f"up // {8 ** n}") for n in range(UPPER)]
    for k, (name, n, tree, at) in enumerate(walk):
        left, right = f"kids[1:({at}) % 8]", f"kids[({at}) % 8 + 2:len(kids)]"
        steps.append(
            f"w{k + 1} AS (SELECT w.* EXCLUDE (others, t), CASE WHEN v.alone THEN others ELSE others || array_to_string({left}, '') "
            f"|| array_to_string({right}, '') END AS others, CASE WHEN v.alone THEN t ELSE sha256(array_to_string({left}, '') || t "
            f"|| array_to_string({right}, '')) END AS t FROM w{k} w JOIN {name}{n + 1} v ON v.tree = {tree} AND v.pos = ({at}) // 8)")
    return ("WITH " + ",\n".join(steps) + f"\nSELECT doc_id, leaf, subroot, root, sha256(others) AS proof_sha256, t AS folded_root, "
            f"t = root AS verified FROM w{len(walk)}")


FILL_IN_MIDDLE = _fill_in_middle()
MERKLE = _merkle()
