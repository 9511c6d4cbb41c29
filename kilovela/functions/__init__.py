"""kilovela.functions"""
