"""Report files: listing, choice of the newest, decryption, parsing, harmonising."""
