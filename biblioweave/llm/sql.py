"""SQL that DuckDB runs over the same tables: the same results by a plainer path."""

from .common import PLACEHOLDERS, SHARED_MAILBOXES

_BLANKS = ", ".join(f"'{x}'" for x in PLACEHOLDERS)
_BOXES = ", ".join(f"'{x}'" for x in SHARED_MAILBOXES)

P1_USABLE = rf"""rows AS (
  SELECT DISTINCT p.canonical_person_id, p.person_id, p.updated_at, p.primary_email, p.current_affiliation, p.country,
         p.h_index, p.articles,
         EXISTS (SELECT 1 FROM source_system_ref s WHERE s.is_trusted AND list_contains(p.source_systems, s.source_system)) AS trusted
  FROM person p WHERE p.canonical_person_id IS NOT NULL
), plain AS (
  SELECT *, regexp_replace(regexp_replace(
      CASE WHEN regexp_matches(primary_email, '<[^<>]*>') THEN regexp_extract(lower(primary_email), '<([^<>]*)>', 1) ELSE lower(trim(primary_email)) END,
      '^\s*mailto:\s*', ''), '^[\s"''(\[<]+|[\s"'')\]>;,.]+$', '', 'g') AS e
  FROM rows
), usable AS (
  SELECT canonical_person_id, person_id, updated_at, trusted, 'primary_email' AS field_name FROM plain
  WHERE regexp_matches(e, '^[\p{{L}}\p{{N}}][\p{{L}}\p{{N}}._%+''-]*@[\p{{L}}\p{{N}}-]+(\.[\p{{L}}\p{{N}}-]+)+$')
    AND replace(regexp_extract(e, '^([^@._+]*)', 1), '-', '') NOT IN ({_BOXES})
  UNION ALL SELECT canonical_person_id, person_id, updated_at, trusted, 'current_affiliation' FROM plain
  WHERE regexp_replace(lower(coalesce(current_affiliation, '')), '[^\p{{L}}\p{{N}}]+', '', 'g') NOT IN ({_BLANKS})
  UNION ALL SELECT canonical_person_id, person_id, updated_at, trusted, 'country' FROM plain
  WHERE regexp_replace(lower(coalesce(country, '')), '[^\p{{L}}\p{{N}}]+', '', 'g') NOT IN ({_BLANKS})
  UNION ALL SELECT canonical_person_id, person_id, updated_at, trusted, 'h_index' FROM plain
  WHERE h_index >= 0 AND NOT coalesce(h_index > articles, false)
), many AS (
  SELECT canonical_person_id FROM rows GROUP BY 1 HAVING count(DISTINCT person_id) > 1
)"""
P1_FOUND = f"""WITH {P1_USABLE}
SELECT canonical_person_id, field_name, person_id FROM usable JOIN many USING (canonical_person_id)
QUALIFY row_number() OVER (PARTITION BY canonical_person_id, field_name ORDER BY trusted DESC, updated_at DESC NULLS LAST, person_id) = 1
"""

# The layer of a champion is one more than the deepest of those that dominate it.
P1_SURVIVORS = f"""WITH RECURSIVE {P1_USABLE}, marked AS (
  SELECT p.canonical_person_id AS g, p.person_id AS id, p.updated_at AS seen, p.trusted,
         list_sort(list(u.field_name) FILTER (u.field_name IS NOT NULL)) AS has, count(u.field_name) AS n_has,
         first(p.e) AS e, first(p.current_affiliation) AS aff, first(p.country) AS country, first(p.h_index) AS h
  FROM plain p JOIN many m ON m.canonical_person_id = p.canonical_person_id
  LEFT JOIN usable u ON u.canonical_person_id = p.canonical_person_id AND u.person_id = p.person_id
  GROUP BY 1, 2, 3, 4
), champs AS (
  SELECT * FROM marked QUALIFY row_number() OVER (PARTITION BY g, has, trusted ORDER BY seen DESC NULLS LAST, id) = 1
), dominated AS (
  SELECT a.g, a.id AS upper_id, b.id AS lower_id FROM champs a JOIN champs b ON a.g = b.g
   AND a.trusted >= b.trusted AND coalesce(a.seen, TIMESTAMP '0001-01-01') >= coalesce(b.seen, TIMESTAMP '0001-01-01') AND a.n_has >= b.n_has
   AND (a.trusted > b.trusted OR coalesce(a.seen, TIMESTAMP '0001-01-01') > coalesce(b.seen, TIMESTAMP '0001-01-01') OR a.n_has > b.n_has)
), walk(g, id, depth) AS (
  SELECT g, id, 1 FROM champs UNION SELECT d.g, d.lower_id, w.depth + 1 FROM walk w JOIN dominated d ON d.g = w.g AND d.upper_id = w.id
), layered AS (
  SELECT c.*, l.layer, row_number() OVER (PARTITION BY c.g ORDER BY c.trusted DESC, c.seen DESC NULLS LAST, c.n_has DESC, c.id) AS place
  FROM champs c JOIN (SELECT g, id, max(depth) AS layer FROM walk GROUP BY 1, 2) l ON l.g = c.g AND l.id = c.id
)
SELECT g AS canonical_person_id, arg_min(id, place) AS survivor_id, {", ".join(
    f"arg_min({value}, place) FILTER (list_contains(has, '{f}')) AS {f}, arg_min(id, place) FILTER (list_contains(has, '{f}')) AS {f}_from, CAST(arg_min(layer, place) FILTER (list_contains(has, '{f}')) AS INTEGER) AS {f}_layer"
    for f, value in (("primary_email", "e"), ("current_affiliation", "aff"), ("country", "country"), ("h_index", "CAST(h AS VARCHAR)"))
)} FROM layered GROUP BY g
"""

_LEAD = (
    r"^[^\p{L}\p{N}]*(?:(?:https?|ftp)[^\p{L}\p{N}]+)?"
    r"(?:(?:dx\W|www\W)?doi\W\p{L}+\W+|(?:dx\W)?doi\b\W*|ut\b\W*wos\b\W*|ut\b\W*|wos\b\W*|accession\W+(?:number|no)\W*)*"
)


def _bare(x: str) -> str:
    return rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}\p{{M}}]+', '', 'g')"


def _ident(x: str) -> str:
    return _bare(f"regexp_replace(lower(regexp_replace(coalesce({x}, ''), '[\\s ]+', ' ', 'g')), '{_LEAD}', '')")


P2_KEYS = f"""
SELECT publication_id, created_at, {_ident("doi")} AS a, {_ident("ut_wos_id")} AS b, {_bare("lower(coalesce(title, ''))")} AS t FROM publication
"""
P2_FOUND = f"""
SELECT min(publication_id) AS keep_id, count(*) AS copies FROM ({P2_KEYS})
GROUP BY least(a, b), greatest(a, b), t, CASE WHEN a = '' AND b = '' AND t = '' THEN publication_id END HAVING count(*) > 1
"""
P2_LEDGER = f"""
SELECT min(publication_id) AS keep_id, count(*) AS copies, min(created_at) AS first_at FROM ({P2_KEYS})
GROUP BY least(a, b), greatest(a, b), t, CASE WHEN a = '' AND b = '' AND t = '' THEN publication_id END
"""

P6_FOUND = """
WITH RECURSIVE edges AS (
  SELECT DISTINCT candidate_a_id AS a, candidate_b_id AS b FROM person_match_audit WHERE decision = 'merge' AND candidate_a_id <> candidate_b_id
  UNION SELECT DISTINCT candidate_b_id, candidate_a_id FROM person_match_audit WHERE decision = 'merge' AND candidate_a_id <> candidate_b_id
), walk(person_id, root) AS (
  SELECT a, a FROM edges
  UNION
  SELECT e.b, w.root FROM walk w JOIN edges e ON e.a = w.person_id WHERE w.root < e.b
)
SELECT min(root) AS group_id, person_id FROM walk GROUP BY person_id
"""

P6_REPORT = f"""
WITH groups AS ({P6_FOUND}),
rows AS (SELECT DISTINCT ON (person_id) person_id, canonical_person_id, cluster_size FROM person)
SELECT group_id, count(*) AS members, count(canonical_person_id) AS matched_before, min(canonical_person_id) AS first_canonical_id, min(cluster_size) AS least_recorded_size,
  max(cluster_size) AS largest_recorded_size, coalesce(min(cluster_size) <> count(*) OR max(cluster_size) <> count(*), false) AS size_is_stale
FROM groups LEFT JOIN rows USING (person_id) GROUP BY group_id
"""

ORACLES = {"p1_found": P1_FOUND, "p1_survivors": P1_SURVIVORS, "p2_found": P2_FOUND, "p2_ledger": P2_LEDGER, "p6_found": P6_FOUND, "p6_report": P6_REPORT}
