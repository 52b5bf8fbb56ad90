"""Formats and defaults that results depend on."""

# --- fixed values: text formats ---
TITLE_OPEN = 'The lyrics of "'
TITLE_CLOSE = '":'
PARAGRAPH = "\n\n"
LINE = "\n"
MISSING = "nan"
STOP_MARK = "。"
COMMA_MARK = "，"

# --- fixed values: reserved tokens ---
PAD = "[PAD]"
UNK = "[UNK]"
CLS = "[CLS]"
SEP = "[SEP]"
SPEAKER_1 = "[speaker1]"
SPEAKER_2 = "[speaker2]"
BASE_TOKENS = (PAD, UNK, CLS, SEP)
SPEAKER_TOKENS = (SPEAKER_1, SPEAKER_2)
EXIT_WORD = "exit"

# --- fixed values: default sizes ---
TEST_ROWS = 500
HELD_OUT_GROUPS = 10
EVALUATED_GROUPS = 1
BLOCK = 1024
MARKS = 2  # taken off a block for the marks of a tokenizer
NEW_TOKENS = 100
CONTEXT = 1024
PROMPT_SEGMENTS = 10
WARMUP_STEPS = 10
BATCH = 4
LEARNING_RATE = 3e-5
