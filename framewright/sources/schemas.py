"""Schemas of the records at the edges (JSON lines), as Spark DDL."""

CAPTION = "id BIGINT, shard BIGINT, path STRING, gt_caption STRING, gemma_short STRING, gemma_dense STRING, dt_s DOUBLE, error STRING"
GROUND = "id BIGINT, shard BIGINT, path STRING, img_wh ARRAY<INT>, grounding MAP<STRING, ARRAY<ARRAY<DOUBLE>>>, n_phrase INT, n_box INT, error STRING"
VERIFY = "path STRING, phrase STRING, box ARRAY<DOUBLE>, n_box INT, crop_frac DOUBLE, verdict STRING, error STRING"
SIDECAR = "path STRING, n_pair INT, n_audited INT, verdict MAP<STRING, ARRAY<STRING>>"
ADJUDICATION = "N_YES BIGINT, N_NO BIGINT, answers ARRAY<STRUCT<path: STRING, phrase: STRING, auto: STRING, human: STRING, crop_frac: DOUBLE>>"
CORRUPT = "_corrupt"
