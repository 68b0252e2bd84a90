"""Names, word lists, patterns and bounds the results depend on."""

from __future__ import annotations

# --- Parameters, in output order (fixed values) ---------------------------------
INT_PARAMS = (
    "rank_value", "lora_alpha", "batch_size", "gradient_accumulation_steps",
    "num_train_epochs", "warmup_steps",
)
FLOAT_PARAMS = ("learning_rate", "lora_dropout")
BOOL_PARAMS = ("bf16", "fp16", "gradient_checkpointing", "merge_and_unload")
NAME_PARAMS = ("optimizer", "lora_bias", "scheduler")

PARAMS = (
    "rank_value", "lora_alpha", "target_modules", "learning_rate", "optimizer",
    "lora_dropout", "lora_bias", "scheduler", "batch_size",
    "gradient_accumulation_steps", "num_train_epochs", "warmup_steps",
    "bf16", "fp16", "gradient_checkpointing", "merge_and_unload",
)
PROVENANCE = (
    "param_sources", "total_params_extracted", "extraction_confidence", "extracted_at",
)
# The parameters the practice statistics are taken over.
PRACTICE_PARAMS = (
    "rank_value", "lora_alpha", "optimizer", "scheduler", "batch_size",
    "num_train_epochs", "gradient_accumulation_steps", "lora_dropout", "bf16",
    "learning_rate", "lora_bias", "warmup_steps", "gradient_checkpointing", "fp16",
)

# --- Spellings of each parameter (fixed values) ---------------------------------
SPELLINGS = {
    "rank_value": ("r", "lora_r", "lora_rank", "rank"),
    "lora_alpha": ("lora_alpha", "alpha"),
    "target_modules": (
        "target_modules", "target_module_list", "lora_target_modules", "modules_to_save",
    ),
    "learning_rate": ("learning_rate", "lr"),
    "optimizer": ("optim", "optimizer", "optimizer_type"),
    "lora_dropout": ("lora_dropout", "dropout"),
    "lora_bias": ("lora_bias", "bias"),
    "scheduler": ("lr_scheduler_type", "scheduler", "lr_scheduler"),
    "batch_size": (
        "per_device_train_batch_size", "batch_size", "train_batch_size", "micro_batch_size",
    ),
    "gradient_accumulation_steps": (
        "gradient_accumulation_steps", "gradient_accumulation", "gradient_accumulation_step",
    ),
    "num_train_epochs": ("num_train_epochs", "epochs", "num_epochs"),
    "warmup_steps": ("warmup_steps", "warmup"),
    "bf16": ("bf16", "bfloat16"),
    "fp16": ("fp16", "float16"),
    "gradient_checkpointing": ("gradient_checkpointing", "use_gradient_checkpointing"),
    "merge_and_unload": ("merge_and_unload",),
}
# Text values that only fill a template and carry nothing; every spelling counts too.
FILLER_WORDS = ("true", "false", "auto")

# --- Extraction layers: priority and confidence (fixed values) ------------------
SOURCE_PRIORITY = {"ast": 4, "json": 3, "yaml": 2, "regex": 1, "llm": 0}
SOURCE_CONFIDENCE = {"ast": 1.0, "json": 1.0, "yaml": 0.9, "regex": 0.5, "llm": 0.7}

CONFIG_CALLS = (
    "LoraConfig", "PeftConfig", "LoftQConfig", "AdaLoraConfig", "TrainingArguments",
    "Seq2SeqTrainingArguments", "DPOConfig", "SFTConfig", "ORPOConfig",
)

# Prose patterns, one captured value each (fixed values).
PROSE_PATTERNS = {
    "rank_value": r"\b(?:lora_)?r(?:ank)?\s*[=:]\s*(\d{1,4})\b",
    "lora_alpha": r"\b(?:lora_)?alpha\s*[=:]\s*(\d{1,5})\b",
    "lora_dropout": r"\b(?:lora_)?dropout\s*[=:]\s*([0-9]*\.?[0-9]+)\b",
    "learning_rate": (
        r"\b(?:learning_rate|lr)\s*[=:]\s*([0-9]*\.?[0-9]+(?:[eE][-+]?\d+)?)\b"
    ),
    "batch_size": r"\b(?:per_device_train_)?batch_size\s*[=:]\s*(\d{1,4})\b",
    "num_train_epochs": r"\b(?:num_train_)?epochs?\s*[=:]\s*(\d{1,4})\b",
    "warmup_steps": r"\bwarmup(?:_steps)?\s*[=:]\s*(\d{1,6})\b",
}
FENCED_BLOCK = r"(?:^|\n)(```|~~~)(\w*)\s*\n(.*?)\n\1"
FRONT_MATTER = r"\A---\s*\n(.*?)\n---\s*\n"

# Accepted value ranges (fixed values).
INT_BOUNDS = {
    "rank_value": (-1, 512),
    "lora_alpha": (1, 1024),
    "batch_size": (1, 1024),
    "gradient_accumulation_steps": (1, 1024),
    "num_train_epochs": (1, 100),
    "warmup_steps": (0, 10000),
}
FLOAT_BOUNDS = {"learning_rate": (1e-9, 10.0), "lora_dropout": (0.0, 1.0)}
TRUE_WORDS = ("1", "true", "yes")
NAME_CHARS = 50

# --- Relevance and off-topic filters (fixed values) -----------------------------
TOPIC_WORDS = (
    "lora", "qlora", "dora", "peft", "lora-finetuning", "lora-training",
    "fine-tuning", "finetuning", "fine-tune", "adapter", "adapters",
    "axolotl", "unsloth", "llama-factory", "llamafactory",
)
REJECT_WORDS = (
    "solidity", "uniswap", "defi", "ethereum", "web3", "arbitrage", "blockchain",
    "nft", "token", "evm", "smart-contract", "metamask", "binance", "coinbase",
    "crypto", "bitcoin", "hardhat", "truffle", "foundry", "airdrop", "staking",
    "yield-farming", "dex", "amm",
)
RADIO_TERMS = (
    "lorawan", "meshtastic", "chirpstack", "the things network", "thethingsnetwork",
    "lpwan", "sx1276", "sx1278", "sx1262", "sx1280", "rfm95", "rfm96", "rfm9x",
    "ttgo", "heltec", "expresslrs", "elrs", "radio control", "rc link", "esp32",
    "esp8266", "arduino", "firmware", "transceiver", "gateway", "ham radio",
    "hamradio", "aprs", "soft radio", "rnode", "reticulum", "iot", "embedded",
)
TUNING_SIGNALS = (
    "fine-tun", "finetun", "peft", "qlora", "diffusion", "stable-diffusion", "llm",
    "large language model", "transformer", "huggingface", "hugging face", "pytorch",
    "adapter", "low-rank", "low rank", "checkpoint", "safetensors", "embedding",
)

# --- Repository paths (fixed values) --------------------------------------------
SKIP_SUFFIXES = (".bin", ".safetensors", ".lock", ".png", ".jpg", ".onnx")
NAMED_FILES = {
    "adapter_config": ("adapter_config.json",),
    "dependencies": (
        "requirements.txt", "pyproject.toml", "environment.yml", "environment.yaml",
    ),
    "config": (
        "accelerate_config.yaml", "deepspeed_config.json", "ds_config.json",
        "training_args.json",
    ),
}
SCRIPT_WORDS = (
    "train", "finetune", "fine_tune", "sft", "run_lora", "run_peft", "run_clm", "run_sft",
)
CONFIG_SUFFIXES = (".yaml", ".yml", ".json", ".toml")
CONFIG_HINTS = ("config", "lora", "peft", "train", "accelerate", "deepspeed", "recipe")
CATEGORY_ORDER = ("training_script", "config", "adapter_config", "dependencies")
DEPENDENCY_FILES = ("requirements.txt", "pyproject.toml", "setup.py", "package.json")

# --- Links between repositories and models (fixed values) -----------------------
MODEL_URL = r"huggingface\.co/([A-Za-z0-9_-]+/[A-Za-z0-9._-]+)"
REPO_URL = r"github\.com/([A-Za-z0-9_-]+/[A-Za-z0-9._-]+)"
GENERIC_NAMES = (
    "lora", "loras", "qlora", "dora", "peft", "adapter", "adapters",
    "lora-finetuning", "lora-training", "finetune", "finetuning", "fine-tuning",
    "llm", "llms", "model", "models", "test", "demo", "example", "examples",
    "ai", "ml", "nlp", "training", "diffusion", "transformer", "transformers",
)
LINK_TYPES = ("readme_direct", "modelcard_direct", "same_username", "fuzzy_name")

# --- Scores and quadrants (fixed values) ----------------------------------------
WEIGHTS = {"downloads": 0.55, "likes": 0.35, "fine_tune_fan_out": 0.10}
MIN_SAMPLE = 3
QUADRANTS = ("common+works", "common+fails", "rare+works", "rare+fails")

# --- Corpus date windows: label, first day, day after the last (fixed values) ----
DATE_WINDOWS = (
    ("created:<2023-01-01", None, "2023-01-01"),
    ("created:2023-01-01..2023-06-30", "2023-01-01", "2023-07-01"),
    ("created:2023-07-01..2023-12-31", "2023-07-01", "2024-01-01"),
    ("created:2024-01-01..2024-06-30", "2024-01-01", "2024-07-01"),
    ("created:2024-07-01..2024-12-31", "2024-07-01", "2025-01-01"),
    ("created:>=2025-01-01", "2025-01-01", None),
)

# --- Question context (fixed values) --------------------------------------------
RECIPE_LABELS = {
    "optimizer": "optimizer",
    "rank_value": "rank",
    "lora_alpha": "alpha",
    "learning_rate": "lr",
    "lora_dropout": "dropout",
    "scheduler": "scheduler",
    "warmup_steps": "warmup",
    "bf16": "bf16",
    "fp16": "fp16",
}
CONTEXT_TAG = r"(?i)</?retrieved_context>"
INSTRUCTION_SPAN = (
    r"(?i)\b(?:ignore|disregard|forget|override)\b[^\n]{0,60}"
    r"\b(?:instruction|prompt|context|system)s?\b"
)
