"""kilovela.operators"""
