"""kilovela.streaming"""
