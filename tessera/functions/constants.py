"""Fixed values that must equal the reference's for identical results.

FIXED VALUES — stated plainly, in their natural order.  Operators take
them as parameter defaults; driver queries may pass other values where the
driver tables need them (documented at the call site).
"""

# --- FIXED VALUES: response quality filter (F1) -----------------------------
REFUSAL_PHRASES = [
    "I cannot",
    "I'm unable to",
    "As an AI",
    "I don't have the ability",
    "I apologize, but",
]
RESPONSE_MIN_LENGTH = 50
GUIDE_REFUSAL_PHRASES = ["I cannot", "I'm unable to", "As an AI", "I don't have the ability"]
GUIDE_MIN_LENGTH = 20
CODE_FENCE = "```"

# --- FIXED VALUES: code quality filter (F3, F5-F8) ---------------------------
MIN_CODE_CHARS = 100
MAX_CODE_CHARS = 100000
MIN_CODE_LINES = 5
MAX_MEAN_LINE_LENGTH = 200
MIN_ALNUM_RATIO = 0.5
MAX_COMMENT_RATIO = 0.5
AUTOGEN_MARKERS = ["auto-generated", "do not edit", "generated by", "this file is generated"]
TEST_MARKERS = ["import unittest", "import pytest", "describe(", "it("]
TEST_KEEP_RATE = 0.2
# (stars strictly greater than, keep rate), checked in order; else the last rate
STAR_TIERS = [(100, 1.0), (10, 0.8)]
STAR_DEFAULT_RATE = 0.3

# --- FIXED VALUES: near-duplicate detection (D2, D3) ------------------------
NEAR_DUP_THRESHOLD = 0.85
NUM_PERM = 128

# --- FIXED VALUES: code-language detection cascade (P3), in order ----------
CODE_LANGUAGE_PATTERNS = [
    ("python", [r"def \w+\(", r"import \w+", r"\bfor \w+ in\b", r":\s*$"]),
    ("javascript", [r"=>", r"function\s+\w+", r"const\s+\w+", r"let\s+\w+", r"var\s+\w+"]),
    ("java", [r"public\s+class", r"public\s+static", r"void\s+\w+\(", r"System\.out"]),
    ("rust", [r"fn\s+\w+", r"let\s+mut", r"impl\s+\w+", r"pub\s+fn"]),
    ("c++", [r"std::", r"#include\s*<", r"cout\s*<<", r"vector<"]),
    ("go", [r"func\s+\w+", r"package\s+\w+", r"import\s+\(", r":="]),
]
EXPLANATION_SNIPPET_PATTERN = r"(?:code does and how it works:|code:)\s*\n(.+)"

# --- FIXED VALUES: language mention in prompts (P5), in search order -------
LANGUAGE_NAMES = [
    "Python", "JavaScript", "TypeScript", "Java", "C++", "Rust",
    "Go", "Ruby", "PHP", "C#", "Kotlin", "Swift",
]

# --- FIXED VALUES: prompt categories -----------------------------------------
CATEGORIES = [
    "function_implementation", "algorithm", "data_structure", "explanation",
    "bug_fix", "refactoring", "real_world", "code_review",
]

# --- FIXED VALUES: completion stop sequences (P13) ---------------------------
STOP_SEQUENCES = ["\nclass ", "\ndef ", "\n#", "\nif __name__"]

# --- FIXED VALUES: sequence sizes ---------------------------------------------
CHUNK_LENGTH = 4096
MIN_CHUNK_LENGTH = 100
BLOCK_LENGTH = 4096
BLOCKS_PER_SHARD = 10000
SUPERVISED_MAX_LENGTH = 2048
IGNORE_INDEX = -100
FIM_RATE = 0.5
PREVIEW_CHARS = 200

# --- FIXED VALUES: special tokens --------------------------------------------
# trainer profile: ids 0..5 in this order
SPECIAL_TOKENS_TRAINER = ["<|pad|>", "<|bos|>", "<|eos|>", "<|fim_prefix|>", "<|fim_middle|>", "<|fim_suffix|>"]
# guide profile, in this order
SPECIAL_TOKENS_GUIDE = [
    "<|endoftext|>", "<|fim_prefix|>", "<|fim_middle|>", "<|fim_suffix|>",
    "<|file_separator|>", "<|lang_python|>", "<|lang_javascript|>",
    "<|lang_typescript|>", "<|lang_java|>", "<|lang_go|>", "<|lang_rust|>",
    "<|lang_cpp|>",
]
FIM_PREFIX = "<|fim_prefix|>"
FIM_SUFFIX = "<|fim_suffix|>"
FIM_MIDDLE = "<|fim_middle|>"
END_OF_TEXT = "<|endoftext|>"
FILE_SEPARATOR = "<|file_separator|>"

# --- FIXED VALUES: teacher prices per 1k tokens (input, output) -------------
TEACHER_PRICES = [
    ("openai", "gpt-4", 0.03, 0.06),
    ("openai", "gpt-4-turbo", 0.01, 0.03),
    ("openai", "gpt-3.5-turbo", 0.0005, 0.0015),
    ("anthropic", "claude-3-opus-20240229", 0.015, 0.075),
    ("anthropic", "claude-3-sonnet-20240229", 0.003, 0.015),
    ("anthropic", "claude-3-haiku-20240307", 0.00025, 0.00125),
]
TEACHER_DEFAULT_PRICES = [("openai", 0.01, 0.03), ("anthropic", 0.003, 0.015)]

# --- FIXED VALUES: target mixture shares (percent) --------------------------
LANGUAGE_SHARES = [
    ("python", 30), ("javascript", 20), ("typescript", 10), ("java", 8),
    ("c/c++", 7), ("go", 7), ("rust", 5), ("php", 4), ("c#", 3),
    ("sql", 2), ("shell", 2), ("other", 2),
]
TYPE_SHARES = [("source", 70), ("docs", 15), ("qa", 10), ("notebooks", 5)]
TIER_SHARES = [("high", 40), ("medium", 40), ("low", 20)]
CURRICULUM_SHARES = [(2048, 50), (4096, 30), (8192, 20)]

# --- FIXED VALUES: score bands (lower bound inclusive, label) ---------------
SCORE_BANDS = [(0, "Weak"), (20, "Basic"), (28, "Competitive"), (35, "Strong"), (45, "Excellent"), (50, "SOTA")]

# --- FIXED VALUES: evaluation ----------------------------------------------
PASS_AT_K = [1, 10, 100]
BUG_WORDS = ["bug", "error", "issue", "problem", "incorrect"]
SEED_TASKS = [
    ("explanation", "Explain what this code does:\n\n"),
    ("documentation", "Write comprehensive documentation for:\n\n"),
    ("test_generation", "Write unit tests for:\n\n"),
    ("refactoring", "Refactor this code for better readability:\n\n"),
]

# --- FIXED VALUES: distillation loss ---------------------------------------
TEMPERATURE = 2.0
HARD_WEIGHT = 0.5

# --- Whitespace as Python's str.isspace() sees it, as a regex class body ----
PY_SPACE = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}"
