"""kilovela.sources"""
