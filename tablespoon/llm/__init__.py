"""Training-data operators: near copies, decontamination, mixing, token files, personal data, secrets, quality."""
