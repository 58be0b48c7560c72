"""Queries of the general data-processing problems."""

from __future__ import annotations

from cohortloom.operators import history, nested
from cohortloom.session import table

QUERIES = {
    "p1_found": lambda spark, d: history.version_starts(table(spark, d, "trials_scd2_snapshots")),
    "p1_versions": lambda spark, d: history.trial_versions(table(spark, d, "trials_scd2_snapshots")),
    "p2_found": lambda spark, d: nested.record_elements(table(spark, d, "clinical_trials"), table(spark, d, "eu_clinical_trials")),
}

#: the date formats of the data, one WHEN for each
_DATE = r"""
CASE WHEN regexp_full_match(s, '\d{4}-\d{1,2}-\d{1,2}') THEN s
     WHEN regexp_full_match(s, '\d{8}') THEN substr(s,1,4)||'-'||substr(s,5,2)||'-'||substr(s,7,2)
     WHEN regexp_full_match(s, '\d{4}/\d{2}/\d{2}') THEN replace(s,'/','-')
     WHEN regexp_full_match(s, '\d{4}[-/]\d{2}') THEN replace(s,'/','-')
     WHEN regexp_full_match(s, '\d{2}/\d{2}/\d{4}') THEN substr(s,7,4)||'-'||substr(s,1,2)||'-'||substr(s,4,2)
     WHEN regexp_full_match(s, '\d{1,2}-[a-z]{3}-\d{2}') THEN strftime(strptime(regexp_replace(s,'-(\d\d)$','-20\1'), '%d-%b-%Y'),'%Y-%m-%d')
     WHEN regexp_full_match(s, '[a-z]+ \d{1,2}, \d{4}') THEN strftime(strptime(regexp_replace(s,'^([a-z]{3})[a-z]*','\1'), '%b %d, %Y'),'%Y-%m-%d')
     WHEN regexp_full_match(s, '[a-z]+ \d{4}') THEN strftime(strptime(regexp_replace(s,'^([a-z]{3})[a-z]*','\1'), '%b %Y'),'%Y-%m')
     ELSE s END"""

_VERSIONS = rf"""
WITH o AS (
  SELECT trial_id, data_collection_date AS ts, processing_timestamp AS w, snapshot_id,
         regexp_replace(lower(coalesce(status,'')), '[^a-z0-9]+', '', 'g') AS st,
         coalesce(CAST(enrollment AS VARCHAR),'') AS en, lower(trim(coalesce(completion_date,''))) AS s
  FROM trials_scd2_snapshots WHERE trial_id IS NOT NULL AND trim(trial_id) <> ''),
k AS (SELECT trial_id, ts, st, en, {_DATE} AS cd,
             row_number() OVER (PARTITION BY trial_id, ts ORDER BY w DESC, snapshot_id DESC) AS rn FROM o),
c AS (SELECT trial_id, ts, st, en, cd FROM k WHERE rn = 1),
l AS (SELECT *, lag(ts) OVER w AS pts, lag(st) OVER w AS pst, lag(en) OVER w AS pen, lag(cd) OVER w AS pcd
      FROM c WINDOW w AS (PARTITION BY trial_id ORDER BY ts))
SELECT trial_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS valid_from
FROM l WHERE pts IS NULL OR pst <> st OR pen <> en OR pcd <> cd"""

_PERIODS = _VERSIONS[: _VERSIONS.index("SELECT trial_id, strftime")] + """, g AS (SELECT *, sum(CASE WHEN pts IS NULL OR pst <> st OR pen <> en OR pcd <> cd THEN 1 ELSE 0 END) OVER (PARTITION BY trial_id ORDER BY ts) AS v FROM l),
r AS (SELECT trial_id, v, min(ts) AS valid_from, max(ts) AS last_seen, count(*) AS observations, any_value(st) AS st, any_value(en) AS en, any_value(cd) AS cd FROM g GROUP BY 1, 2)
SELECT trial_id AS entity, '{"status":'||to_json(st)::VARCHAR||',"enrollment":'||to_json(en)::VARCHAR||',"completion_date":'||to_json(cd)::VARCHAR||'}' AS payload, valid_from, last_seen, lead(valid_from) OVER (PARTITION BY trial_id ORDER BY valid_from) AS valid_to, observations FROM r"""

SQL = {"p1_found": _VERSIONS, "p1_versions": _PERIODS}
