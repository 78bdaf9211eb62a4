"""Operators that prepare text for language model training. Nothing else imports this part."""
