"""The warehouse itself: dimensions, facts, mart, audit and backtest."""
