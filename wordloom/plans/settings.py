"""Parameters of the registered queries, shared with their SQL."""

from __future__ import annotations

SEED = 7
COOC_MIN_COUNT = 20
WINDOW = 5
SMOOTHING = 0.75
PHRASE_MIN_COUNT = 5
PHRASE_THRESHOLD = 10.0
LM_MIN_COUNT = 25
CONTEXT = 4
BATCH = 64
FILE_BATCHES = 250
W2V_MIN_COUNT = 5
W2V_WINDOW = 5
SAMPLE = 0.001
TOP_N = 5
SVD_K = 50
NEGATIVE = 5
W2V_EPOCHS = 20
W2V_CHUNK_WORDS = 8192
